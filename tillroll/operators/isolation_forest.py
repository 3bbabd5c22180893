"""Isolation forest (Liu, Ting and Zhou, 2008) over Spark partitions.

Bags are drawn by hashing row ids, one task grows one tree from its small bag, and every row is
scored where it lies against the broadcast trees. Nothing depends on how the rows are partitioned.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Executors need not have this package: its functions travel to them by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TREES = 200
BAG_SIZE = 256
SEED = 42
#: Tasks that grow trees; a bag is small, so there is no need for one to each tree.
TASKS = 32

NODES = (
    "tree int, node int, feature int, threshold double, size int, bag_size int"
)

_BITS = 1 << 40


def _chance(*parts: Column) -> Column:
    """A number in [0, 1) that depends on ``parts`` alone."""
    return F.pmod(F.xxhash64(*parts), F.lit(_BITS)) / F.lit(float(_BITS))


def draw_bags(
    rows: DataFrame,
    key: str,
    features: Sequence[str],
    trees: int = TREES,
    bag_size: int = BAG_SIZE,
    seed: int = SEED,
) -> DataFrame:
    """(tree, draw, key, features): a little more than ``bag_size`` candidates for each tree.

    A tree's bag is its ``bag_size`` rows of lowest draw, without replacement. Each row joins each
    tree with the same chance, independently, at every size of table. Which trees it joins is drawn
    as skips along the trees' numbers: on a large table the first skip leads past the last tree for
    nearly all rows, which costs one hash a row.
    """
    total = rows.agg(F.count("*").alias("n")).scalar()
    # Six standard deviations above the wanted size, so that a bag practically never falls short.
    candidates = bag_size + 6 * math.sqrt(bag_size)
    chance = F.lit(candidates) / F.greatest(total, F.lit(1))
    counted = rows.select(
        F.col(key).cast("long").alias("key"),
        *[F.col(name).cast("double").alias(name) for name in features],
        chance.alias("__p"),
    )

    def skip(step: Column) -> Column:
        """Trees passed over before the next one that the row joins."""
        u = _chance(F.col("key"), step, F.lit(seed)) + F.lit(0.5 / _BITS)
        far = F.floor(F.log(u) / F.log1p(-F.least(F.col("__p"), F.lit(0.999999))))
        return F.when(F.col("__p") >= 1, F.lit(0)).otherwise(
            F.least(far, F.lit(trees)).cast("int")
        )

    def join_next(acc: Column, step: Column) -> Column:
        tree = acc["next"]
        draw = _chance(F.col("key"), tree, F.lit(seed), F.lit(1))
        joined = F.concat(acc["trees"], F.array(F.struct(tree.alias("tree"), draw.alias("draw"))))
        done = tree >= trees
        return F.struct(
            F.when(done, tree).otherwise(tree + 1 + skip(step)).alias("next"),
            F.when(done, acc["trees"]).otherwise(joined).alias("trees"),
        )

    none = F.array().cast("array<struct<tree:int,draw:double>>")
    # So many trees no row joins: with their mean known, more have a chance below 1e-20.
    mean = F.least(F.col("__p"), F.lit(1.0)) * float(trees)
    most = F.least(F.lit(trees), F.ceil(mean + F.sqrt(mean) * 10 + 12)).cast("int")
    draws = F.aggregate(
        F.sequence(F.lit(1), most),
        F.struct(F.col("__first").alias("next"), none.alias("trees")),
        join_next,
        lambda acc: acc["trees"],
    )
    return (
        counted.withColumn("__first", skip(F.lit(0)))
        .filter(F.col("__first") < trees)
        .select("key", *features, F.explode(draws).alias("d"))
        .select("d.tree", "d.draw", "key", *features)
    )


def fit_forest(
    rows: DataFrame,
    key: str,
    features: Sequence[str],
    trees: int = TREES,
    bag_size: int = BAG_SIZE,
    seed: int = SEED,
) -> DataFrame:
    """One row per node of every tree; children of node i are 2i+1 and 2i+2.

    A node with no feature is a leaf. At most ``trees * 2 * 2**height`` rows come out, whatever
    the input's size.
    """
    names = list(features)

    def fit(key_: tuple, bag: pd.DataFrame) -> pd.DataFrame:
        tree = int(key_[0])
        bag = bag.sort_values(["draw", "key"]).head(bag_size).sort_values("key")
        height = math.ceil(math.log2(max(len(bag), 2)))
        nodes = _grow(bag[names].to_numpy(float), height, np.random.default_rng([seed, tree]))
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "size"])
        return out.assign(tree=tree, bag_size=len(bag))[
            ["tree", "node", "feature", "threshold", "size", "bag_size"]
        ]

    # All bags together are a few megabytes, which adaptive execution would leave to one task; a
    # stated number of partitions lets the trees grow side by side.
    tasks = min(trees, TASKS)
    return (
        draw_bags(rows, key, names, trees, bag_size, seed)
        .repartition(tasks, "tree")
        .groupBy("tree")
        .applyInPandas(fit, NODES)
    )


def _grow(points: np.ndarray, height: int, rng: np.random.Generator) -> list[tuple]:
    """Split at random until points are alone, alike or at the height limit."""
    nodes = []
    waiting = [(0, 0, points)]
    while waiting:
        node, depth, here = waiting.pop()
        low, high = here.min(axis=0), here.max(axis=0)
        splittable = np.flatnonzero(high > low)
        if depth == height or len(splittable) == 0:
            nodes.append((node, -1, 0.0, len(here)))
            continue
        feature = int(rng.choice(splittable))
        threshold = rng.uniform(low[feature], high[feature])
        if threshold >= high[feature]:  # rounding must not leave the right side empty
            threshold = low[feature]
        right = here[:, feature] > threshold
        nodes.append((node, feature, threshold, len(here)))
        waiting.append((2 * node + 2, depth + 1, here[right]))
        waiting.append((2 * node + 1, depth + 1, here[~right]))
    return nodes


def expected_path(size: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of ``size`` points."""
    n = np.asarray(size, dtype=float)
    inner = np.maximum(n, 3.0)
    long = 2.0 * (np.log(inner - 1.0) + np.euler_gamma) - 2.0 * (inner - 1.0) / inner
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long))


def _packed(nodes: pd.DataFrame) -> dict[str, np.ndarray]:
    """Node rows as arrays indexed [tree, node], so that a level is one gather."""
    trees = np.sort(nodes["tree"].unique())
    slot = np.searchsorted(trees, nodes["tree"].to_numpy())
    node = nodes["node"].to_numpy()
    depth = np.floor(np.log2(node + 1)).astype(int)
    shape = (len(trees), int(2 ** (depth.max() + 1) - 1))
    feature = np.zeros(shape, dtype=np.int64)
    # A leaf's threshold is infinite and never passed: rows stay in its left-most descendant,
    # whose depth and size are those of the leaf.
    threshold = np.full(shape, np.inf)
    path = np.zeros(shape)
    inner = nodes["feature"].to_numpy() >= 0
    feature[slot[inner], node[inner]] = nodes["feature"].to_numpy()[inner]
    threshold[slot[inner], node[inner]] = nodes["threshold"].to_numpy()[inner]
    leaf = ~inner
    for s, n, d, size in zip(slot[leaf], node[leaf], depth[leaf], nodes["size"].to_numpy()[leaf]):
        last = n
        while 2 * last + 1 < shape[1]:
            last = 2 * last + 1
        path[s, last] = d + expected_path(size)
    bag_size = nodes.groupby("tree")["bag_size"].first().to_numpy(float)
    return {
        "feature": feature,
        "threshold": threshold,
        "path": path,
        "levels": int(depth.max()),
        "normal": float(expected_path(bag_size).mean()),
    }


def _mean_path(forest: dict[str, np.ndarray], points: np.ndarray) -> np.ndarray:
    """Mean path length of each point, trees added in fixed order.

    All points step down a tree together: flat gathers, with columns laid end to end.
    """
    count = len(points)
    columns = np.ascontiguousarray(points.T).ravel()
    rows = np.arange(count)
    total = np.zeros(count)
    starts = forest["feature"] * count
    for start, threshold, path in zip(starts, forest["threshold"], forest["path"]):
        node = np.zeros(count, dtype=np.int64)
        for _ in range(forest["levels"]):
            right = columns.take(start.take(node) + rows) > threshold.take(node)
            node *= 2
            node += 1
            node += right
        total += path.take(node)
    return total / len(forest["feature"])


def score_rows(
    rows: DataFrame,
    forest: DataFrame,
    features: Sequence[str],
    keep: Sequence[str],
    name: str = "raw_score",
) -> DataFrame:
    """``keep`` plus the score in (0, 1), higher for rows that are isolated sooner.

    The node table is bounded by the number of trees and the bag size, so it is collected and
    broadcast; the rows stay where they are.
    """
    names, kept = list(features), list(keep)
    nodes = forest.toPandas()
    if nodes.empty:  # nothing to learn from
        return rows.select(*kept, F.lit(None).cast("double").alias(name))
    shared = rows.sparkSession.sparkContext.broadcast(_packed(nodes))

    def score(batches):
        trees = shared.value
        for batch in batches:
            points = batch[names].to_numpy(float)
            normal = trees["normal"]
            strange = np.exp2(-_mean_path(trees, points) / normal) if normal else 1.0
            yield batch[kept].assign(**{name: strange})

    inputs = kept + [
        F.col(column).cast("double").alias(column) for column in names if column not in kept
    ]
    schema = rows.select(*kept).schema.add(name, "double")
    return rows.select(*inputs).mapInPandas(score, schema)
