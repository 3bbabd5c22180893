"""Silhouettes on Euclidean distance to a stated error, without all pairs.

A point's distances to ``n`` points with middle ``m`` and mean squared distance ``v`` from it, when it
is ``d`` away from ``m``, sum up to at least ``n * d`` and at most ``n * sqrt(d**2 + v)`` (Jensen's
inequality, from below and from above). Far away the two are close, and their mean stands for the sum.

The points of a cluster are put in Morton order and cut into leaves, and every ``FAN`` nodes that
follow each other have a node above them, which keeps a count, a sum and a sum of squares. The leaves
are also the targets: each starts with the top nodes of all clusters, and level by level a node that
is far enough from all of the target's points is taken as it is, while any other is replaced by the
nodes below it. Only leaves that are near to each other bring their points together. How near follows
from the error, not from n: once the points lie dense enough, a target meets some nodes of each level,
and the work grows with n log n.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.lloyd import finite, morton_code, ranges_of
from tillroll.operators.rfm import SCALED
from tillroll.session import new_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Points to a leaf, at most, and nodes below a node.
LEAF = 256
FAN = 8
POINTS_PER_PARTITION = 500_000
ERROR = 0.01


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _leaves(points: DataFrame, axes: int, key: T.DataType, leaf: int) -> DataFrame:
    """(label, id, keys, points, n, sums, square, middle, radius): the leaves of each label's points,
    numbered from 0 in Morton order."""
    names = [f"x{i}" for i in range(axes)]
    n, ranges = ranges_of(points, names)
    code = morton_code(names, ranges)
    partitions = max(1, -(-n // POINTS_PER_PARTITION))
    order = ["label", "code", *names]
    schema = T.StructType(
        [
            T.StructField("label", T.IntegerType()),
            T.StructField("task", T.IntegerType()),
            T.StructField("nth", T.LongType()),
            T.StructField("keys", T.ArrayType(key)),
            T.StructField("points", T.ArrayType(T.DoubleType())),
            T.StructField("n", T.LongType()),
            T.StructField("sums", T.ArrayType(T.DoubleType())),
            T.StructField("square", T.DoubleType()),
            T.StructField("middle", T.ArrayType(T.DoubleType())),
            T.StructField("radius", T.DoubleType()),
        ]
    )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        nth: dict[int, int] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            label = batch.column("label").to_numpy()
            places = np.stack([batch.column(x).to_numpy() for x in names], axis=1)
            starts = np.append(np.flatnonzero(np.diff(label, prepend=label[0] - 1)), len(label))
            own = [np.arange(a, b, leaf) for a, b in zip(starts, starts[1:], strict=False)]
            edges = np.append(np.concatenate(own), len(label))
            rows = []
            for a, b in zip(edges, edges[1:], strict=False):
                own, mark = places[a:b], int(label[a])
                middle = own.mean(axis=0)
                away = ((own - middle) ** 2).sum(axis=1)
                count = nth[mark] = nth.get(mark, -1) + 1
                rows.append((mark, count, own.sum(axis=0), away.sum(), middle, math.sqrt(away.max()), b - a))
            marks, counts, sums, squares, middles, radii, n = zip(*rows, strict=True)
            doubles = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(marks, pa.int32()),
                    pa.array([task] * len(rows), pa.int32()),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(edges, pa.int32()), batch.column("key")),
                    pa.ListArray.from_arrays(pa.array(edges * axes, pa.int32()), pa.array(places.ravel())),
                    pa.array(n, pa.int64()),
                    pa.array(sums, doubles),
                    pa.array(squares, pa.float64()),
                    pa.array(middles, doubles),
                    pa.array(radii, pa.float64()),
                ],
                names=schema.names,
            )

    laid = points.withColumn("code", code).repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    found = _stored(laid.select("key", "label", *names).mapInArrow(gather, schema), "leaves")
    # One row for each label and partition that has points of it.
    spans = found.groupBy("label", "task").agg(F.count("*").alias("leaves"))
    before = Window.partitionBy("label").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("label", "task", F.coalesce(F.sum("leaves").over(before), F.lit(0)).alias("before"))
    numbered = found.join(spans, ["label", "task"]).withColumn("id", F.col("before") + F.col("nth"))
    return _stored(numbered.drop("task", "nth", "before"), "numbered-leaves")


def _nodes_above(nodes: DataFrame, axes: int) -> DataFrame:
    """The level above: ``square`` is the sum of squared distances from the node's own middle."""
    n = F.sum("n")
    sums = [F.sum(F.col("sums")[i]) for i in range(axes)]
    # A child's points add their spread around its middle, and its middle's around the node's.
    raw = [F.sum(F.col("sums")[i] ** 2 / F.col("n")) for i in range(axes)]
    between = F.lit(0.0)
    for own, total in zip(raw, sums, strict=True):
        between = between + F.greatest(own - total**2 / n, F.lit(0.0))
    above = F.floor(F.col("id") / FAN).cast("long").alias("id")
    return nodes.groupBy("label", above).agg(
        n.alias("n"), F.array(*sums).alias("sums"), (F.sum("square") + between).alias("square")
    )


def _away(middle: Column, sums: Column, n: Column, axes: int) -> Column:
    squares = F.lit(0.0)
    for i in range(axes):
        squares = squares + (middle[i] - sums[i] / n) ** 2
    return F.sqrt(squares)


def silhouette_within(
    features: DataFrame,
    error: float = ERROR,
    key: str = "customer_id",
    columns: Sequence[str] = SCALED,
    label: str = "cluster",
    leaf: int = LEAF,
) -> DataFrame:
    """(key, label, silhouette): each point's silhouette, at most ``error`` from the exact one.

    Every sum of distances is met to a share of tanh(``error`` / 2). The silhouette is a function of
    the logarithm of the ratio of two such sums, with a slope of at most one, so it is ``error`` off
    at most. A point alone in its cluster, or with no other cluster, has silhouette 0. Rows without a
    number in every coordinate or without a label are left out; labels are whole numbers.
    """
    axes = len(columns)
    kind = features.schema[key].dataType
    usable = features.filter(finite(columns) & F.col(label).isNotNull())
    # From the middle of all points, so that squares stay small.
    middle = usable.agg(*[F.avg(F.col(name).cast("double")) for name in columns]).first()
    points = usable.select(
        F.col(key).alias("key"),
        F.col(label).cast("int").alias("label"),
        *[(F.col(name).cast("double") - (middle[i] or 0.0)).alias(f"x{i}") for i, name in enumerate(columns)],
    )
    share = math.tanh(error / 2)
    leaves = _leaves(points, axes, kind, leaf)
    levels = [leaves.select("label", "id", "n", "sums", "square")]
    while (levels[-1].agg(F.max("id")).first()[0] or 0) >= FAN:
        levels.append(_stored(_nodes_above(levels[-1], axes), "nodes"))

    # The clusters' sizes and top nodes: at most FAN rows for each cluster.
    tops = [tuple(row) for row in levels[-1].select("label", "id").orderBy("label", "id").collect()]
    sizes = {row["label"]: int(row["n"]) for row in levels[-1].groupBy("label").agg(F.sum("n").alias("n")).collect()}
    if not tops:
        return features.select(key, label, F.lit(0.0).alias("silhouette")).limit(0)
    start = F.array(*[F.struct(F.lit(a).alias("label"), F.lit(b).cast("long").alias("id")) for a, b in tops])
    target = ("t_label", "t_id")
    targets = leaves.select(F.col("label").alias("t_label"), F.col("id").alias("t_id"), "middle", "radius")
    frontier = targets.select("*", F.explode(start).alias("node")).select(*target, "middle", "radius", "node.*")
    taken = []
    for height in range(len(levels) - 1, -1, -1):
        nodes = levels[height]
        met = frontier.join(nodes, ["label", "id"])
        least = _away(F.col("middle"), F.col("sums"), F.col("n"), axes) * (1 - 1e-9) - F.col("radius")
        spread = F.col("square") / F.col("n")
        # sqrt(d ** 2 + spread) is at most (1 + 2 * share) * d.
        far = (least > 0) & (spread <= least * least * (4 * share * (1 + share)))
        met = _stored(met.withColumn("far", (F.col("square") == 0) | far), "meetings")
        taken.append(met.filter("far").select(*target, "label", "n", "sums", "square"))
        near = met.filter(~F.col("far"))
        below = F.explode(F.sequence(F.col("id") * FAN, F.col("id") * FAN + FAN - 1)).alias("id")
        frontier = near.select(*target, "middle", "radius", "label", below if height else "id")
    empty = F.lit(None).cast("array<double>")
    sources = frontier.join(leaves.select("label", "id", "points"), ["label", "id"]).select(
        *target, "label", F.lit(0).cast("long").alias("n"), empty.alias("sums"), F.lit(0.0).alias("square"), "points"
    )
    for part in taken:
        sources = sources.unionByName(part.withColumn("points", empty))
    result = T.StructType(
        [
            T.StructField(key, kind),
            T.StructField(label, T.IntegerType()),
            T.StructField("silhouette", T.DoubleType()),
        ]
    )
    marks = sorted(sizes)

    def measure(leaf: pa.Table, sources: pa.Table) -> pa.Table:
        own = leaf.column("own").combine_chunks().flatten().to_numpy().reshape(-1, axes)
        mine = leaf.column("t_label")[0].as_py()
        total = np.zeros((len(own), len(marks)))
        which = np.searchsorted(marks, sources.column("label").to_numpy())
        n = sources.column("n").to_numpy()
        square = sources.column("square").to_numpy()
        summed = np.flatnonzero(n > 0)
        sums = sources.column("sums").combine_chunks().flatten().to_numpy().reshape(-1, axes)
        for place, middle in zip(summed.tolist(), sums / n[summed, None], strict=True):
            squares = ((own - middle) ** 2).sum(axis=1)
            both = np.sqrt(squares) + np.sqrt(squares + square[place] / n[place])
            total[:, which[place]] += both * (n[place] / 2)
        for place in np.flatnonzero(n == 0).tolist():
            other = sources.column("points")[place].values.to_numpy().reshape(-1, axes)
            squares = np.zeros((len(own), len(other)))
            for axis in range(axes):
                squares += (own[:, axis, None] - other[None, :, axis]) ** 2
            total[:, which[place]] += np.sqrt(squares).sum(axis=1)
        value = np.zeros(len(own))
        if len(marks) > 1 and sizes[mine] > 1:
            place = marks.index(mine)
            inner = total[:, place] / (sizes[mine] - 1)
            means = total / np.array([sizes[mark] for mark in marks])
            outer = np.delete(means, place, axis=1).min(axis=1)
            most = np.maximum(inner, outer)
            value = np.where(most > 0, (outer - inner) / np.where(most > 0, most, 1), 0.0)
        return pa.table(
            [
                leaf.column("own_keys").combine_chunks().flatten(),
                pa.array(np.full(len(own), mine, np.int32)),
                pa.array(value),
            ],
            names=result.names,
        )

    mine = leaves.select(F.col("label").alias("t_label"), F.col("id").alias("t_id"), F.col("keys").alias("own_keys"), F.col("points").alias("own"))
    found = mine.groupBy(*target).cogroup(sources.groupBy(*target)).applyInArrow(measure, result)
    return found.withColumn(label, F.col(label).cast(features.schema[label].dataType))
