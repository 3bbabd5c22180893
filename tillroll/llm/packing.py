"""Best-fit packing of token pieces into sequences, bulk-synchronously.

The pieces are range-sorted by descending length, the gaps of the open sequences are kept sorted by
size, and a round sweeps all pieces of one length at once: they take the gaps of the successor
size, the smallest that holds them. Where more pieces want a gap size than there are gaps of it,
rank decides: the first so many get one (as many in a gap as fit), the others go to the next larger
size, and what no gap holds opens new sequences. Gap sizes are updated and the next length follows.
The outcome is that of best-fit decreasing over all pieces.

Pieces of one length are interchangeable, and so are gaps of one size, so a round's state is kept as
runs of ranks: at most one entry per length, plus the runs of sequences filled alike. That is bounded
by the sequence length, whatever the number of documents, and it is all that the driver sees. Sorting,
ranking, and placing the pieces are done where the pieces are.
"""

from __future__ import annotations

import bisect
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.frames import stored
from tillroll.llm.tokens import END_ID, MAX_TOKENS, token_pieces

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Ranks of one length that are joined with their runs at a time.
RANKS = 256

Run = tuple[int, int, int, int, int, int]


def best_fit_runs(counts: dict[int, int], size: int) -> list[Run]:
    """Where the pieces go: (length, first rank, ranks, per sequence, first sequence, offset).

    Of a run's ranks, so many at a time go side by side into one sequence, from ``offset`` on.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # size of gap: runs (first sequence, sequences)
    sizes: list[int] = []
    runs: list[Run] = []
    opened = 0

    def keep(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            else:
                gap, first = size, opened
                n = -(-left // (size // length))
                opened += n
            per = gap // length
            full = min(n, left // per)
            rest = min(left - full * per, per) if full < n else 0
            taken = full * per + rest
            runs.append((length, rank, taken, per, first, size - gap))
            keep(gap - per * length, first, full)
            if rest:
                keep(gap - rest * length, first + full, 1)
            keep(gap, first + full + bool(rest), n - full - bool(rest))
            rank, left = rank + taken, left - taken
    return runs


def _numbered(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``__task`` and ``__place``, the place among the task's of one length. Sorted."""
    schema = T.StructType(
        [*pieces.schema.fields, T.StructField("__task", T.IntegerType()), T.StructField("__place", T.LongType())]
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        last, place = -1, 0
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            if not len(length):
                continue
            new = np.ones(len(length), dtype=bool)
            new[1:] = length[1:] != length[:-1]
            begin = np.flatnonzero(new)
            places = np.arange(len(length)) - np.repeat(begin, np.diff(np.append(begin, len(length))))
            if length[0] == last:
                run = begin[1] if len(begin) > 1 else len(length)
                places[:run] += place
            last, place = int(length[-1]), int(places[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(length), task, np.int32)), pa.array(places)],
                names=schema.names,
            )

    return pieces.mapInArrow(number, schema)


def pack(pieces: DataFrame, size: int = MAX_TOKENS) -> DataFrame:
    """``pieces``' columns, with ``sequence_id`` and ``offset`` (long).

    ``pieces`` has an integer column ``length`` of 1 to ``size``. Every row is placed, equal rows
    apart from each other; a sequence is filled from 0 without gaps. No rows give none. Input
    columns named ``sequence_id`` or ``offset`` must not be there.
    """
    spark = pieces.sparkSession
    columns = pieces.columns
    order = [F.desc("length"), F.xxhash64(*columns), *[c for c in columns if c != "length"]]
    ranked = stored(
        _numbered(pieces.repartitionByRange(*order).sortWithinPartitions(*order)), "ranked-pieces"
    )
    by_task = stored(ranked.groupBy("length", "__task").agg(F.count("*").alias("n")), "piece-runs")
    # One row per length: at most ``size`` rows come to the driver.
    counts = {
        int(row["length"]): int(row["n"])
        for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    wrong = [length for length in counts if not 1 <= length <= size]
    if wrong:
        raise ValueError(f"pieces of {wrong[0]} tokens do not go into sequences of {size}")
    before = Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_task.select(
        "length", "__task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")
    )
    runs = spark.createDataFrame(
        best_fit_runs(counts, size) or [],
        "length long, __rank long, __ranks long, __per long, __first long, __offset long",
    )
    last = F.col("__rank") + F.col("__ranks") - 1
    by_block = runs.select(
        "*",
        F.explode(
            F.sequence(
                F.floor(F.col("__rank") / RANKS).cast("long"), F.floor(last / RANKS).cast("long")
            )
        ).alias("__block"),
    )
    rank = F.col("__before") + F.col("__place")
    placed = (
        ranked.join(starts, ["length", "__task"])
        .withColumn("__own", rank)
        .withColumn("__block", F.floor(F.col("__own") / RANKS).cast("long"))
        .join(by_block, ["length", "__block"])
        .filter(
            (F.col("__own") >= F.col("__rank")) & (F.col("__own") < F.col("__rank") + F.col("__ranks"))
        )
    )
    nth = F.col("__own") - F.col("__rank")
    return placed.select(
        *columns,
        (F.col("__first") + F.floor(nth / F.col("__per"))).cast("long").alias("sequence_id"),
        (F.col("__offset") + F.pmod(nth, F.col("__per")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    key: str = "doc_id",
    text: str = "text",
    max_tokens: int = MAX_TOKENS,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """``token_pieces`` of ``docs``, packed. The pieces are stored first: a range sort reads its
    input twice, and texts should be encoded once."""
    pieces = token_pieces(docs, tokenizer_path, key, text, max_tokens, end_id, with_ids)
    return pack(stored(pieces, "token-pieces"), max_tokens)
