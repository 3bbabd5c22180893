"""K-Means on the scaled features, and how good a clustering is."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.distance_sums import distance_sums
from tillroll.operators.lloyd import (
    Model,
    cells_of,
    cheapest,
    finite,
    fit_models,
    morton_code,
    ranges_of,
    squared_silhouettes,
)
from tillroll.operators.rfm import SCALED
from tillroll.operators.silhouette import silhouette_within
from tillroll.session import new_path

# Executors need not have this package: its functions travel to them by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_PARTITION = 500_000

# Points to a block of the exact silhouette, at most.
BLOCK = 2_048
# Groups of points whose pairs are its tasks: the root of the points over this, so that what moves between
# tasks and what a task holds both grow with the points times their root.
GROUPS = 50
# Sums that a task holds for a group, at most.
SUMS = 1 << 23


def feature_vectors(
    features: DataFrame, key: str = "customer_id", columns: Sequence[str] = SCALED
) -> DataFrame:
    """Add the vector column, laid out the same way whatever the input's partitioning.

    Sums of floats follow the partitions' order, so rows are hashed by key into a number of
    partitions that follows from their count, and sorted inside.
    """
    partitions = max(1, -(-features.count() // ROWS_PER_PARTITION))
    placed = features.repartition(partitions, key).sortWithinPartitions(key)
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(placed)


def best_of_starts(
    features: DataFrame,
    k: int,
    starts: int = 10,
    seed: int = 42,
    key: str = "customer_id",
    columns: Sequence[str] = SCALED,
) -> Model:
    """The cheapest of several starts, which are fitted together."""
    return cheapest(fit_models(features, [k], starts, seed, key, columns))[0]


def fit_clusters(
    features: DataFrame, k: int = 3, starts: int = 10, seed: int = 42
) -> DataFrame:
    """Customers with their cluster. Labels run from the highest mean spend down, so they keep
    their meaning when the fit finds the clusters in another order."""
    model = best_of_starts(features, k, starts, seed)
    found = [(i, centre) for i, centre in enumerate(model.centres.tolist()) if model.sizes[i]]
    if not found:
        return features.withColumn("cluster", F.lit(None).cast("int"))
    spend = (
        assign_to_centroids(features, found)
        .groupBy("cluster")
        .agg(F.avg(F.col("monetary").cast("double")).alias("spend"))
        .orderBy(F.desc("spend"), "cluster")
        .collect()
    )
    rank = {row["cluster"]: i for i, row in enumerate(spend)}
    return assign_to_centroids(features, [(rank[i], centre) for i, centre in found])


def assign_to_centroids(
    features: DataFrame,
    centroids: Iterable[tuple[int, Sequence[float]]],
    columns: Sequence[str] = SCALED,
) -> DataFrame:
    """Add the label of the nearest centre; on equal distance the lowest label.

    The k centres are literals in one expression, so this is a projection.
    """

    def candidate(label: int, centre: Sequence[float]) -> Column:
        squares = [(F.col(name) - F.lit(float(x))) ** 2 for name, x in zip(columns, centre)]
        return F.struct(sum(squares[1:], squares[0]).alias("d"), F.lit(label).alias("label"))

    candidates = [candidate(label, centre) for label, centre in centroids]
    nearest = F.least(*candidates) if len(candidates) > 1 else candidates[0]
    return features.withColumn("cluster", nearest["label"])


def centroids_of(
    clustered: DataFrame, columns: Sequence[str] = SCALED, label: str = "cluster"
) -> list[tuple[int, list[float]]]:
    """Mean of each cluster in feature space (k rows)."""
    rows = clustered.groupBy(label).agg(*[F.avg(name).alias(name) for name in columns]).collect()
    return sorted((row[label], [row[name] for name in columns]) for row in rows)


def squared_silhouette(vectors: DataFrame, label: str = "cluster") -> float:
    """Silhouette on squared Euclidean distance over all rows; linear in the rows."""
    return ClusteringEvaluator(
        predictionCol=label, featuresCol="features", distanceMeasure="squaredEuclidean"
    ).evaluate(vectors)


def euclidean_silhouette(
    features: DataFrame,
    key: str = "customer_id",
    columns: Sequence[str] = SCALED,
    label: str = "cluster",
    block: int = BLOCK,
) -> DataFrame:
    """Silhouette of every point on Euclidean distance (Rousseeuw 1987): (key, label, silhouette).

    Every point's distances to all points are summed, at every size, to the rounding of the sums
    (``distance_sums``). Points near each other are laid together, in blocks of at most ``block`` and
    groups of blocks; each pair of groups is one task, which hands on a sum for each of its points and
    each cluster. A point with a NaN or a null coordinate is NaN away from all. Rows without a label
    have silhouette 0 and are in no cluster.
    """
    spark = features.sparkSession
    names = [f"x{i}" for i in range(len(columns))]
    own_key, own_label = features.schema[key].dataType, features.schema[label].dataType
    nowhere = F.lit(math.nan)
    points = features.select(
        F.col(key).alias("key"),
        F.col(label).alias("label"),
        *[F.coalesce(F.col(name).cast("double"), nowhere).alias(x) for name, x in zip(columns, names)],
    )
    counted = points.groupBy("label").agg(F.count("*").alias("n")).filter(F.col("label").isNotNull())
    # One row for each cluster.
    counted = sorted((tuple(row) for row in counted.collect() if row["label"] == row["label"]), key=str)
    sizes = np.array([n for _, n in counted], np.int64)
    labels = len(sizes)
    marks = F.array(*[F.lit(value).cast(own_label) for value, _ in counted])
    mark = F.coalesce(F.array_position(marks, F.col("label")) - 1, F.lit(-1)) if labels else F.lit(-1)

    placed, ranges = ranges_of(points.filter(finite(names)), names)
    n = max(placed, int(sizes.sum()))
    cores = spark.sparkContext.defaultParallelism
    groups = max(math.sqrt(n) / GROUPS, math.sqrt(8 * cores), n * labels / SUMS)
    groups = max(1, min(math.ceil(groups), -(-n // (4 * block))))
    blocks = _blocks_of(points.withColumn("mark", mark.cast("int")), names, ranges, groups, block)
    # The blocks came in as many tasks as groups were asked for, about equal; one row for each.
    tasks = blocks.groupBy("task").agg(F.sum(F.size("marks")).alias("n")).orderBy("task").collect()
    group_of = {row["task"]: i for i, row in enumerate(tasks)}
    groups = len(tasks)
    if not groups or not labels:
        return points.limit(0).select(
            F.col("key").alias(key), F.col("label").alias(label), F.lit(0.0).alias("silhouette")
        )
    group_of_task = F.array(*[F.lit(group_of.get(i, -1)) for i in range(max(group_of) + 1)])
    own_group = F.element_at(group_of_task, F.col("task") + 1)

    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    pairs = blocks.select("task", "nth", "marks", "places", own_group.alias("group"), every.alias("other"))
    low, high = F.least("group", "other"), F.greatest("group", "other")
    # Pairs have the numbers of a triangle's places, row by row.
    before = F.floor((low * (2 * groups + 1) - low * low) / 2).cast("int")
    pairs = pairs.withColumns({"same": low == high, "pair": before + high - low})
    axes = len(names)

    def sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in _rows_of(batch)]
        if not rows:
            return
        rows.sort(key=lambda row: row[:3])
        here = rows[0][0]
        sides = [[row for row in rows if row[0] == here], [row for row in rows if row[0] != here]]
        sides = sides[: 1 if rows[0][3] else 2]
        totals = distance_sums(
            [np.concatenate([row[5] for row in side]).reshape(-1, axes) for side in sides],
            [np.concatenate([row[4] for row in side]) for side in sides],
            labels,
            block,
        )
        for side, total in zip(sides, totals, strict=True):
            ends = np.cumsum([0, *[len(row[4]) for row in side]])
            for row, a, b in zip(side, ends, ends[1:], strict=False):
                values = pa.array(total[a:b].ravel())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row[1]], pa.int32()),
                        pa.array([row[2]], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values),
                    ],
                    names=["task", "nth", "sums"],
                )

    moved = pairs.select("pair", "group", "task", "nth", "same", "marks", "places").repartitionById(
        groups * (groups + 1) // 2, F.col("pair")
    )
    found = moved.drop("pair").mapInArrow(sums_of, "task int, nth bigint, sums array<double>")
    out = T.StructType(
        [
            T.StructField("key", own_key),
            T.StructField("label", own_label),
            T.StructField("other", T.IntegerType()),
            T.StructField("total", T.DoubleType()),
            T.StructField("points", T.LongType()),
        ]
    )

    def add_up(own: pa.Table, sums: pa.Table) -> pa.Table:
        total = sum(one.values.to_numpy() for one in sums.column("sums"))
        keys = own.column("keys").combine_chunks().flatten()
        each = pa.array(np.repeat(np.arange(len(keys)), labels))
        return pa.table(
            [
                keys.take(each),
                own.column("labels").combine_chunks().flatten().take(each),
                pa.array(np.tile(np.arange(labels, dtype=np.int32), len(keys))),
                pa.array(total),
                pa.array(np.tile(sizes, len(keys))),
            ],
            names=out.names,
        )

    block_id = ("task", "nth")
    sums = (
        blocks.select(*block_id, "keys", "labels")
        .groupBy(*block_id)
        .cogroup(found.groupBy(*block_id))
        .applyInArrow(add_up, out)
        .withColumn("other", F.element_at(marks, F.col("other") + 1))
        .groupBy("key", "label", "other")
        .agg(F.sum("total").alias("total"), F.sum("points").alias("points"))
    )
    own = F.col("other") == F.col("label")
    means = sums.groupBy("key", "label").agg(
        F.max(F.when(own & (F.col("points") > 1), F.col("total") / (F.col("points") - 1))).alias("inner"),
        F.min(F.when(~own, F.col("total") / F.col("points"))).alias("outer"),
    )
    value = F.try_divide(F.col("outer") - F.col("inner"), F.greatest("inner", "outer"))
    # A point alone in its cluster, or with no other cluster, has silhouette 0.
    return means.select(
        F.col("key").alias(key), F.col("label").alias(label), F.coalesce(value, F.lit(0.0)).alias("silhouette")
    )


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(group, task, nth, same, marks, places) of each row."""
    plain = [batch.column(name).to_pylist() for name in ("group", "task", "nth", "same")]
    for i, row in enumerate(zip(*plain, strict=True)):
        yield *row, batch.column("marks")[i].values.to_numpy(), batch.column("places")[i].values.to_numpy()


def _blocks_of(
    points: DataFrame, names: Sequence[str], ranges: Sequence[tuple[float, float]], tasks: int, block: int
) -> DataFrame:
    """(task, nth, keys, labels, marks, places): up to ``block`` points that follow each other in Morton
    order, stored. Equal points are told apart by their keys, so that they fill several tasks too."""
    order = [morton_code(names, ranges).alias("code"), *[F.col(x) for x in names], F.xxhash64("key").alias("hash")]
    columns = ["key", "label", "mark", *names]
    schema = T.StructType(
        [
            T.StructField("task", T.IntegerType()),
            T.StructField("nth", T.LongType()),
            T.StructField("keys", T.ArrayType(points.schema["key"].dataType)),
            T.StructField("labels", T.ArrayType(points.schema["label"].dataType)),
            T.StructField("marks", T.ArrayType(T.IntegerType())),
            T.StructField("places", T.ArrayType(T.DoubleType())),
        ]
    )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            places = np.stack([batch.column(x).to_numpy() for x in names], axis=1)
            edges = np.append(np.arange(0, batch.num_rows, block), batch.num_rows)
            rows = pa.array(edges, pa.int32())
            lists = [pa.ListArray.from_arrays(rows, batch.column(x)) for x in ("key", "label", "mark")]
            count = len(edges) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([task] * count, pa.int32()),
                    pa.array(range(nth, nth + count), pa.int64()),
                    *lists,
                    pa.ListArray.from_arrays(pa.array(edges * len(names), pa.int32()), pa.array(places.ravel())),
                ],
                names=schema.names,
            )
            nth += count

    laid = points.select("*", order[0], order[-1])
    order = ["code", *names, "hash"]
    laid = laid.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select(*columns)
    path = new_path(points.sparkSession, "blocks")
    laid.mapInArrow(gather, schema).write.parquet(path)
    return points.sparkSession.read.schema(schema).parquet(path)


def k_sweep(
    features: DataFrame,
    k_range: Iterable[int] = range(2, 9),
    starts: int = 10,
    seed: int = 42,
    euclidean: bool = False,
    error: float | None = None,
) -> DataFrame:
    """(k, inertia, silhouette_squared[, silhouette]): what to look at when choosing k.

    All starts of all k are fitted together, in as many passes as the slowest takes, and measured in
    two more. Rows without a number in every coordinate are left out.

    ``euclidean`` adds the silhouette on plain distance: to the rounding of its sums, or within ``error``.
    """
    cells = cells_of(features, SCALED)
    models = cheapest(fit_models(features, list(k_range), starts, seed, "customer_id", SCALED, cells))
    squared = squared_silhouettes(cells, [model.centres for model in models]) if models else []
    rows = []
    for model, value in zip(models, squared, strict=True):
        row = (model.k, model.cost, value)
        if euclidean:
            labelled = assign_to_centroids(features, list(enumerate(model.centres.tolist())))
            points = euclidean_silhouette(labelled) if error is None else silhouette_within(labelled, error)
            mean = points.agg(F.avg("silhouette")).first()[0]
            row = (*row, float(mean))
        rows.append(row)
    schema = "k int, inertia double, silhouette_squared double"
    return features.sparkSession.createDataFrame(
        rows, schema + (", silhouette double" if euclidean else "")
    )
