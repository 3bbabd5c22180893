"""K-Means for many models at once: every pass over the points moves the centres of all of them.

A sweep over k with ten starts each is seventy models. Fitted one by one, each reads the points in
each of its iterations; here a pass assigns every point in every model that still moves and brings
back one row for each cluster, so the seventy take as many passes as the slowest one.

Points are stored once in cells: up to ``CELL`` points that follow each other in Morton order, so a
cell is compact, with its middle, radius and sums. Hamerly's bounds (2010) are taken by cell: a point
is at most a radius farther from the centre that is nearest to the cell's middle, and at most a radius
nearer to the second nearest. Where the first bound is below the second the cell goes to that centre
whole, by its sums, and its points are not looked at. That never changes an assignment.

Coordinates are whole multiples of a power of two, and sums are sums of whole numbers. So centres are
the same under any partitioning, any cells and in any order of the rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.session import new_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Points to a cell, at most; points to a partition of the stored cells.
CELL = 128
POINTS_PER_PARTITION = 500_000
#: A small table is cut for all cores, but not into fewer points than this.
LEAST_POINTS = 2_048
#: Sums of so many tasks are added up by the driver, of more by an aggregation first.
FEW_TASKS = 64
#: Rows from which first centres are drawn, those whose key hashes lowest.
SAMPLE = 10_000
#: Centres have settled once none moves by more than this.
TOLERANCE = 0.01
MAX_STEPS = 300

#: Bits of a coordinate's whole number, and of a squared distance's; sums travel in halves of 32 bits.
_BITS = 40
_LOW = (1 << 32) - 1


class Cells(NamedTuple):
    """``table``: a row for each cell, in ``tasks`` files. A coordinate is its whole number over
    2 ** ``scale``."""

    table: DataFrame
    scale: int
    axes: int
    tasks: int


class Model(NamedTuple):
    """A fitted model. ``sizes`` and ``cost`` (sum of squared distances) are of the final centres."""

    k: int
    start: int
    centres: np.ndarray
    sizes: list[int]
    cost: float
    steps: int


def finite(columns: Sequence[str]) -> Column:
    """Whether all coordinates are numbers."""
    whole = F.lit(True)
    for name in columns:
        x = F.col(name).cast("double")
        whole = whole & x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    return whole


def ranges_of(points: DataFrame, names: Sequence[str]) -> tuple[int, list[tuple[float, float]]]:
    """The number of rows, and each column's least and greatest value."""
    seen = points.agg(
        F.count("*").alias("n"),
        *[F.min(x).cast("double").alias(f"low_{x}") for x in names],
        *[F.max(x).cast("double").alias(f"high_{x}") for x in names],
    ).first()
    return int(seen["n"]), [(seen[f"low_{x}"] or 0.0, seen[f"high_{x}"] or 0.0) for x in names]


def morton_code(names: Sequence[str], ranges: Sequence[tuple[float, float]]) -> Column:
    """A number that is close for points that are close: the bits of their places, in turn."""
    bits = min(16, 62 // len(names))
    one = F.lit(1).cast("long")
    code = F.lit(0).cast("long")
    for i, (x, (low, high)) in enumerate(zip(names, ranges, strict=True)):
        # Halves, since the difference of two large numbers may not be finite.
        share = (F.col(x).cast("double") / 2 - low / 2) / F.lit(max(high / 2 - low / 2, 5e-324))
        level = F.greatest(F.lit(0.0), F.least(share * float(1 << bits), F.lit(float((1 << bits) - 1)))).cast("long")
        for bit in range(bits):
            code = code.bitwiseOR(F.shiftleft(F.shiftright(level, bit).bitwiseAND(one), bit * len(names) + i))
    return code


def cells_of(features: DataFrame, columns: Sequence[str], cell: int = CELL) -> Cells:
    """The points of ``features`` in cells, written to the shared folder.

    Rows with a coordinate that is null, NaN or infinite are left out.
    """
    axes = len(columns)
    points = features.filter(finite(columns)).select(
        *[F.col(name).cast("double").alias(f"x{i}") for i, name in enumerate(columns)]
    )
    names = points.columns
    n, ranges = ranges_of(points, names)
    most = max((abs(end) for ends in ranges for end in ends), default=0.0)
    scale = _BITS - (math.frexp(most)[1] if most else 0)
    whole = points.select(*[F.rint(F.col(x) * F.lit(2.0**scale)).cast("long").alias(x) for x in names])
    code = morton_code(names, [(low * 2.0**scale, high * 2.0**scale) for low, high in ranges])
    cores = features.sparkSession.sparkContext.defaultParallelism
    partitions = max(1, -(-n // POINTS_PER_PARTITION), min(cores, n // LEAST_POINTS))
    order = ["code", *names]
    schema = T.StructType(
        [
            T.StructField("points", T.ArrayType(T.LongType())),
            T.StructField("middle", T.ArrayType(T.DoubleType())),
            T.StructField("radius", T.DoubleType()),
            T.StructField("sums", T.ArrayType(T.LongType())),
        ]
    )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.stack([batch.column(x).to_numpy() for x in names], axis=1)
            edges = np.arange(0, len(values) + cell, cell).clip(max=len(values))
            if len(values) == 0:
                continue
            edges = np.unique(edges)
            middles, radii, sums = [], [], []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                own = values[a:b]
                place = own / 2.0**scale
                middle = place.mean(axis=0)
                middles.append(middle)
                radii.append(math.sqrt(((place - middle) ** 2).sum(axis=1).max()))
                sums.append(own.sum(axis=0))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array(edges * axes, pa.int32()), pa.array(values.ravel())),
                    pa.array(list(middles), pa.list_(pa.float64())),
                    pa.array(radii),
                    pa.array(list(sums), pa.list_(pa.int64())),
                ],
                names=schema.names,
            )

    laid = whole.withColumn("code", code).repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    path = new_path(features.sparkSession, "cells")
    laid.select(*names).mapInArrow(gather, schema).write.parquet(path)
    return Cells(features.sparkSession.read.schema(schema).parquet(path), scale, axes, partitions)


class _Block(NamedTuple):
    """Some cells: ``first`` says where each one's points begin, and the end."""

    points: np.ndarray
    first: np.ndarray
    middle: np.ndarray
    radius: np.ndarray
    sums: np.ndarray


def _blocks(batch: pa.RecordBatch, axes: int, most: int = 2048) -> Iterator[_Block]:
    for a in range(0, batch.num_rows, most):
        part = batch.slice(a, most)
        points = part.column("points")
        lengths = np.diff(np.asarray(points.offsets)) // axes

        def flat(name: str, part: pa.RecordBatch = part) -> np.ndarray:
            return part.column(name).flatten().to_numpy().reshape(-1, axes)

        yield _Block(
            flat("points"),
            np.append(0, np.cumsum(lengths)),
            flat("middle"),
            part.column("radius").to_numpy(),
            flat("sums"),
        )


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each centre."""
    out = np.zeros((len(points), len(centres)))
    for axis in range(points.shape[1]):
        out += (points[:, axis, None] - centres[None, :, axis]) ** 2
    return out


def _halves(total: int) -> tuple[int, int]:
    return total >> 32, total & _LOW


class _Sums:
    """Whole numbers summed by cluster without overflow."""

    def __init__(self, clusters: int, width: int):
        self._held = np.zeros((clusters, width), object)
        self._used = np.zeros(clusters, dtype=bool)

    def add(self, cluster: np.ndarray, values: np.ndarray) -> None:
        """``values`` are below 2 ** 62 over the number of rows."""
        order = np.argsort(cluster, kind="stable")
        own, begin = np.unique(cluster[order], return_index=True)
        if len(own):
            self._held[own] += np.add.reduceat(values[order], begin, axis=0).astype(object)
            self._used[own] = True

    def batch(self, names: list[str]) -> pa.RecordBatch:
        own = np.flatnonzero(self._used)
        columns = [pa.array(own, pa.int32())]
        for i in range(self._held.shape[1]):
            parts = [_halves(int(x)) for x in self._held[own, i]]
            columns += [pa.array([x[side] for x in parts], pa.int64()) for side in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, names=names)


def _summed(cells: Cells, clusters: int, width: int, run) -> np.ndarray:
    """``run(block, sums)`` over all cells; the sums of each cluster, (clusters, width) whole numbers.

    A task has one row for each cluster; so has the aggregation, or the driver gets those of
    ``FEW_TASKS`` tasks at most.
    """
    names = ["cluster", *[f"{half}_{i}" for i in range(width) for half in ("high", "low")]]
    schema = T.StructType(
        [T.StructField("cluster", T.IntegerType()), *[T.StructField(name, T.LongType()) for name in names[1:]]]
    )
    axes = cells.axes

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(clusters, width)
        for batch in batches:
            for block in _blocks(batch, axes):
                run(block, sums)
        yield sums.batch(names)

    rows = cells.table.mapInArrow(task, schema)
    if cells.tasks > FEW_TASKS:
        rows = rows.groupBy("cluster").agg(*[F.sum(name).alias(name) for name in names[1:]])
    out = np.zeros((clusters, width), object)
    for row in rows.collect():
        for i in range(width):
            out[row["cluster"], i] += (row[f"high_{i}"] << 32) + row[f"low_{i}"]
    return out


def _begins(centres: Sequence[np.ndarray]) -> list[int]:
    return np.cumsum([0, *[len(own) for own in centres]]).tolist()


def lloyd_step(cells: Cells, centres: Sequence[np.ndarray]) -> list[tuple[np.ndarray, list[int]]]:
    """One iteration of all models: each one's new centres and its clusters' sizes, in one pass.

    A point goes to its nearest centre, of equally near ones to the first. A centre without points
    stays where it is.
    """
    begin = _begins(centres)
    every = np.concatenate([np.asarray(own, float) for own in centres])
    scale, axes = cells.scale, cells.axes

    def run(block: _Block, sums: _Sums) -> None:
        away = np.sqrt(_squares(block.middle, every))
        size = np.diff(block.first)
        whole = np.concatenate([block.sums, size[:, None]], axis=1)
        points = None
        # What rounding may have done to a distance.
        slack = 1e-9 * (block.radius + np.abs(block.middle).max(axis=1) + np.abs(every).max())
        for a, b in zip(begin, begin[1:], strict=False):
            own = away[:, a:b]
            nearest = own.argmin(axis=1)
            upper = own[np.arange(len(own)), nearest] + block.radius
            if b - a > 1:
                lower = np.partition(own, 1, axis=1)[:, 1] - block.radius
            else:
                lower = np.full(len(own), np.inf)
            open_ = ~(upper + slack < lower)
            sums.add(a + nearest[~open_], whole[~open_])
            if not open_.any():
                continue
            if points is None:
                points = block.points / 2.0**scale
            mine = np.flatnonzero(np.repeat(open_, size))
            label = _squares(points[mine], every[a:b]).argmin(axis=1)
            one = np.ones((len(mine), 1), np.int64)
            sums.add(a + label, np.concatenate([block.points[mine], one], axis=1))

    totals = _summed(cells, len(every), axes + 1, run)
    moved = []
    for (a, b), before in zip(zip(begin, begin[1:], strict=False), centres, strict=True):
        sizes = [int(n) for n in totals[a:b, axes]]
        after = np.array(
            [
                [float(s) / n / 2.0**scale for s in own[:axes]] if n else list(old)
                for own, n, old in zip(totals[a:b], sizes, before, strict=True)
            ]
        )
        moved.append((after, sizes))
    return moved


def _measured(cells: Cells, centres: Sequence[np.ndarray]) -> tuple[list[list[int]], list[np.ndarray], list[np.ndarray], list[float]]:
    """By model: sizes, coordinate sums, sums of squares, and the cost, for the given centres."""
    begin = _begins(centres)
    every = np.concatenate([np.asarray(own, float) for own in centres])
    scale, axes = cells.scale, cells.axes
    most = float(np.abs(every).max()) + 2.0 ** (_BITS - scale)
    # Squared distances as whole numbers of at most so many bits.
    fine = 2.0 ** (_BITS - math.frexp(4 * axes * most * most)[1])

    def run(block: _Block, sums: _Sums) -> None:
        points = block.points / 2.0**scale
        norm = np.rint((points**2).sum(axis=1) * fine).astype(np.int64)
        one = np.ones(len(points), np.int64)
        for a, b in zip(begin, begin[1:], strict=False):
            away = _squares(points, every[a:b])
            label = away.argmin(axis=1)
            near = np.rint(away[np.arange(len(away)), label] * fine).astype(np.int64)
            sums.add(a + label, np.column_stack([block.points, one, norm, near]))

    totals = _summed(cells, len(every), axes + 3, run)
    sizes, places, norms, costs = [], [], [], []
    for a, b in zip(begin, begin[1:], strict=False):
        sizes.append([int(n) for n in totals[a:b, axes]])
        places.append(totals[a:b, :axes].astype(float) / 2.0**scale)
        norms.append(totals[a:b, axes + 1].astype(float) / fine)
        costs.append(float(totals[a:b, axes + 2].sum()) / fine)
    return sizes, places, norms, costs


def first_centres(sample: np.ndarray, k: int, start: int, seed: int) -> np.ndarray:
    """``k`` rows of ``sample`` by k-means++ (Arthur and Vassilvitskii 2007): each next one with a
    chance in proportion to its squared distance from those chosen. Fewer if rows repeat."""
    draw = np.random.default_rng([seed, start, k])
    chosen = [int(draw.integers(len(sample)))]
    nearest = ((sample - sample[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k and nearest.sum() > 0:
        upto = np.cumsum(nearest)
        place = int(np.searchsorted(upto, draw.random() * upto[-1], side="right"))
        chosen.append(min(place, len(sample) - 1))
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def fit_from(
    cells: Cells,
    centres: Sequence[np.ndarray],
    tolerance: float = TOLERANCE,
    max_steps: int = MAX_STEPS,
) -> list[tuple[np.ndarray, int]]:
    """Lloyd's iterations of all models from the given centres until none of a model's centres moves
    by more than ``tolerance``: the centres and the number of iterations of each. Models that have
    settled take no part in further passes."""
    now = [np.asarray(own, float) for own in centres]
    steps = [0] * len(now)
    open_ = list(range(len(now)))
    for _ in range(max_steps):
        if not open_:
            break
        still = []
        for i, (after, _) in zip(open_, lloyd_step(cells, [now[i] for i in open_]), strict=True):
            if math.sqrt(((after - now[i]) ** 2).sum(axis=1).max()) > tolerance:
                still.append(i)
            now[i], steps[i] = after, steps[i] + 1
        open_ = still
    return list(zip(now, steps, strict=True))


def fit_models(
    features: DataFrame,
    ks: Sequence[int],
    starts: int,
    seed: int,
    key: str,
    columns: Sequence[str],
    cells: Cells | None = None,
) -> list[Model]:
    """``starts`` models for each number of clusters in ``ks``, fitted together.

    First centres come from at most ``SAMPLE`` rows, those whose key hashes lowest; every iteration
    covers all rows. The result does not depend on how ``features`` is partitioned.
    """
    cells = cells or cells_of(features, columns)
    names = [F.col(name).cast("double").alias(name) for name in columns]
    lowest = features.filter(finite(columns)).select(F.xxhash64(F.col(key), F.lit(seed)).alias("__hash"), *names)
    sample = np.array(
        [tuple(row)[1:] for row in lowest.orderBy("__hash", *columns).limit(SAMPLE).collect()], float
    ).reshape(-1, len(columns))
    wanted = [(k, start) for k in ks for start in range(starts)]
    if len(sample) == 0:
        return [Model(k, start, np.zeros((0, len(columns))), [], 0.0, 0) for k, start in wanted]
    fitted = fit_from(cells, [first_centres(sample, k, start, seed) for k, start in wanted])
    sizes, _, _, costs = _measured(cells, [centres for centres, _ in fitted])
    return [
        Model(k, start, centres, own, cost, steps)
        for (k, start), (centres, steps), own, cost in zip(wanted, fitted, sizes, costs, strict=True)
    ]


def cheapest(models: Sequence[Model]) -> list[Model]:
    """For each k the model of least cost, of equal ones the first start."""
    best: dict[int, Model] = {}
    for model in sorted(models, key=lambda model: (model.k, model.cost, model.start)):
        best.setdefault(model.k, model)
    return [best[k] for k in sorted(best)]


def squared_silhouettes(cells: Cells, centres: Sequence[np.ndarray]) -> list[float]:
    """The mean silhouette on squared distance of each model's clusters, all models in two passes.

    A point's mean squared distance to a cluster follows from the cluster's size, sum and sum of
    squares. A point alone in its cluster counts 0, and so do all points of a single cluster.
    """
    sizes, places, norms, _ = _measured(cells, centres)
    begin = _begins(centres)
    every = np.concatenate([np.asarray(own, float) for own in centres])
    scale, fine = cells.scale, 2.0**40

    def run(block: _Block, sums: _Sums) -> None:
        points = block.points / 2.0**scale
        norm = (points**2).sum(axis=1)
        each = np.arange(len(points))
        for i, (a, b) in enumerate(zip(begin, begin[1:], strict=False)):
            label = _squares(points, every[a:b]).argmin(axis=1)
            n = np.array(sizes[i], float)
            total = norm[:, None] * n + norms[i] - 2 * points @ places[i].T
            mean = np.where(n > 0, total / np.maximum(n, 1), np.inf)
            mean[each, label] = np.inf
            other = mean.min(axis=1)
            mine = total[each, label] / np.maximum(n[label] - 1, 1)
            most = np.maximum(mine, other)
            value = np.where((n[label] > 1) & np.isfinite(other) & (most > 0), (other - mine) / np.where(most > 0, most, 1), 0.0)
            value = np.where(np.isfinite(value), value, 0.0)
            sums.add(np.full(len(points), i), np.rint(value * fine).astype(np.int64)[:, None])

    totals = _summed(cells, len(centres), 1, run)
    return [
        float(totals[i, 0]) / fine / max(1, sum(own)) for i, own in enumerate(sizes)
    ]
