"""Exact interpolated quantiles that never gather a column in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a KLL sketch, and the rank error, as a share, that it keeps to but for one in a hundred.
SKETCH = 4096
SKETCH_ERROR = 0.001
#: Quantiles read from a sketch.
GRID = 2048
#: Values between a column's brackets that are brought to the driver, at most, by the sketch's word.
SETTLE = 200_000
#: Sketches are merged in so many groups first.
_GROUPS = 64
_BINS = 4096


@dataclass
class _Search:
    """A 0-based rank among ``n`` finite values from ``least`` to ``greatest``.

    ``low`` and ``high`` bracket it, and about ``inside`` values lie between them. ``below`` is used
    by the histograms, which search from ``low`` to ``high`` inclusive.
    """

    rank: int
    n: int
    least: float
    greatest: float
    low: float
    high: float
    inside: float
    below: int = 0
    found: tuple[float, float] | None = None
    lost: bool = False


def exact_quantiles(df: DataFrame, columns: Sequence[str], q: float) -> dict[str, float | None]:
    """The ``q``-quantile of each column by linear interpolation; None for an empty column.

    NULL and NaN are left out; infinite values rank at the ends. A first pass sketches every column
    (KLL, Karnin, Lang and Liberty 2016), whatever its spread. The sketch brackets the wanted rank
    between two values, and the next pass counts what lies below and at them and gathers what lies
    between, at most about ``SETTLE`` values, from which the rank is settled exactly. Of columns with
    more than that between the brackets, beyond some thirty million rows, the pass sketches the
    values between instead, and the search goes on there. A bracket that turns out not to hold the
    rank, which a sketch allows one time in a hundred, is given up for histograms of equal bins.

    All columns share each pass. Each pass reads ``df`` again: hand in a stored table.
    """
    columns = list(columns)
    numbers = df.select(*[F.col(name).cast("double").alias(f"v{i}") for i, name in enumerate(columns)])
    infinity = F.lit(float("inf"))

    def finite(i: int) -> Column:
        v = F.col(f"v{i}")
        return F.when(~F.isnan(v) & (v < infinity) & (v > -infinity), v)

    every = range(len(columns))
    counted = {f"under{i}": F.count_if(F.col(f"v{i}") == -infinity) for i in every}
    counted |= {f"over{i}": F.count_if(F.col(f"v{i}") == infinity) for i in every}
    first = _pass(numbers, counted, {i: finite(i) for i in every}, {})
    searches: dict[int, _Search] = {}
    shares: dict[int, float] = {}
    for i in every:
        n, under, over, grid = (first[f"{part}{i}"] for part in ("n", "under", "over", "grid"))
        if n + under + over == 0:
            continue
        position = q * (n + under + over - 1)
        rank = math.floor(position)
        shares[i] = position - rank
        least, greatest = (grid[0], grid[-1]) if n else (math.inf, math.inf)
        search = searches[i] = _Search(rank - under, n, least, greatest, least, greatest, n)
        if rank < under or rank >= under + n:
            end = -math.inf if rank < under else math.inf
            after = end if rank + 1 != under else least
            search.found = (end, end if end > 0 else after)
        else:
            _bracket(search, search.rank, n, grid)
    while open_ := {i: x for i, x in searches.items() if x.found is None and not x.lost}:
        counted, sketched, gathered = {}, {}, {}
        for i, search in open_.items():
            v = finite(i)
            counted[f"below{i}"] = F.count_if(v < search.low)
            counted[f"low{i}"] = F.count_if(v == search.low)
            counted[f"high{i}"] = F.count_if((v == search.high) & (v > search.low))
            between = F.when((v > search.low) & (v < search.high), v)
            (gathered if search.inside <= SETTLE else sketched)[i] = between
        row = _pass(numbers, counted, sketched, gathered)
        for i, search in open_.items():
            _judge(search, row, i)
    _narrow(numbers, finite, {i: x for i, x in searches.items() if x.lost})
    out: dict[str, float | None] = dict.fromkeys(columns)
    for i, search in searches.items():
        low, high = search.found
        share = shares[i]
        out[columns[i]] = low if share == 0 or low == high else low + (high - low) * share
    return out


def _pass(numbers: DataFrame, counted: dict, sketched: dict, gathered: dict):
    """One row from one pass: ``counted`` by name, and by column ``n`` values, and of ``sketched``
    a ``grid`` of quantiles, of ``gathered`` the ``values``. Tasks are merged by groups first."""
    inner = dict(counted)
    outer = {name: F.coalesce(F.sum(name), F.lit(0)) for name in counted}
    grids = {}
    for i, v in (sketched | gathered).items():
        inner[f"n{i}"], outer[f"n{i}"] = F.count(v), F.coalesce(F.sum(f"n{i}"), F.lit(0))
    for i, v in sketched.items():
        inner[f"sketch{i}"] = F.kll_sketch_agg_double(v, F.lit(SKETCH))
        outer[f"sketch{i}"] = F.kll_merge_agg_double(f"sketch{i}", F.lit(SKETCH))
        ranks = F.lit(np.arange(GRID + 1) / GRID)  # one literal: as many take seconds to plan
        grids[f"grid{i}"] = F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"sketch{i}", ranks))
    for i, v in gathered.items():
        inner[f"values{i}"] = F.collect_list(v)
        outer[f"values{i}"] = F.flatten(F.collect_list(f"values{i}"))
    group = F.pmod(F.spark_partition_id(), F.lit(_GROUPS)).alias("group")
    merged = numbers.groupBy(group).agg(*[x.alias(name) for name, x in inner.items()])
    whole = merged.agg(*[x.alias(name) for name, x in outer.items()])
    return whole.withColumns(grids).drop(*[f"sketch{i}" for i in sketched]).first()


def _bracket(search: _Search, place: int, n: int, grid: Sequence[float]) -> None:
    """Put ``low`` and ``high`` around places ``place`` and ``place`` + 1 among the ``n`` values of
    which ``grid`` has the quantiles. A side beyond the grid stays where it is."""
    spread = math.ceil(2 * SKETCH_ERROR * GRID) + 1
    left = math.floor(place / n * GRID) - spread
    right = math.ceil((place + 2) / n * GRID) + spread
    if left >= 0:
        search.low = grid[left]
    if right <= GRID:
        search.high = grid[right]
    search.inside = n * ((min(right, GRID) - max(left, 0)) / GRID + 2 * SKETCH_ERROR)


def _judge(search: _Search, row, i: int) -> None:
    """What a pass over the bracket of column ``i`` says: the values, a closer bracket, or that the
    rank is not in it."""
    below, at_low, between, at_high = (row[f"{part}{i}"] for part in ("below", "low", "n", "high"))
    values = sorted(row[f"values{i}"]) if search.inside <= SETTLE else None

    def value(rank: int) -> float | None:
        """Null: between the brackets, not known yet."""
        if rank >= search.n:
            return math.inf
        if rank < below + at_low:
            return search.low
        if rank < below + at_low + between:
            return values[rank - below - at_low] if values is not None else None
        return search.high

    end = below + at_low + between + at_high
    if search.rank < below or min(search.rank + 1, search.n - 1) >= end:
        search.lost = True
        return
    low, high = value(search.rank), value(search.rank + 1)
    if low is not None and high is not None:
        search.found = (low, high)
    else:
        _bracket(search, max(0, search.rank - below - at_low), between, row[f"grid{i}"])


def exact_quantile(df: DataFrame, column: str, q: float) -> float | None:
    return exact_quantiles(df, [column], q)[column]


def _narrow(numbers: DataFrame, finite, searches: dict[int, _Search]) -> None:
    """Search by histograms until every column has its values at ``rank`` and ``rank + 1``.

    The range of a column is cut into equal bins, counted by an ordinary aggregation, and the search
    goes on between the least and the greatest value of the bin that holds the wanted rank. The ends
    of a range fall into different bins, so every pass leaves fewer distinct values.
    """
    for search in searches.values():
        search.low, search.high, search.below = search.least, search.greatest, 0
    while True:
        open_ = {}
        for i, search in searches.items():
            if search.found is None and search.low == search.high:
                _settle(search, search.high)
            if search.found is None:
                open_[i] = search
        if not open_:
            return
        candidates = []
        for i, search in open_.items():
            v, low, high = finite(i), F.lit(search.low), F.lit(search.high)
            # Halves, since the difference of two large numbers may not be finite.
            place = (v / 2 - low / 2) / F.lit(search.high / 2 - search.low / 2)
            if search.high / 2 - search.low / 2 == 0:  # neighbouring numbers next to zero
                place = F.when(v == low, F.lit(0.0)).otherwise(F.lit(1.0))
            bin_ = F.when(v.between(low, high), F.floor(place * float(_BINS)))
            candidates.append(F.struct(F.lit(i).alias("i"), bin_.alias("bin"), v.alias("v")))
        rows = (
            numbers.select(F.explode(F.array(*candidates)).alias("c"))
            .filter(F.col("c.bin").isNotNull())
            .groupBy("c.i", "c.bin")
            .agg(F.count("*").alias("rows"), F.min("c.v").alias("low"), F.max("c.v").alias("high"))
            .orderBy("i", "bin")
            .collect()
        )
        for i, search in open_.items():
            bins = [row for row in rows if row["i"] == i]
            for here, after in zip(bins, [*bins[1:], None]):
                if search.rank < search.below + here["rows"]:
                    break
                search.below += here["rows"]
            if search.rank + 1 == search.below + here["rows"]:
                _settle(search, here["high"], after["low"] if after else None)
            search.low, search.high = here["low"], here["high"]


def _settle(search: _Search, low: float, high: float | None = None) -> None:
    """``low`` is the value at the rank. Without a next value in sight it is followed by itself, or
    by what ranks above all finite values."""
    if high is None:
        high = low if search.rank + 1 < search.n else math.inf
    search.found = (low, high)
