"""Silhouettes to a stated error against the exact ones."""

from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillroll.operators import silhouette

COLUMNS = ["a", "b", "c"]


def table(spark, n, labels=4, seed=2, spread=1.0):
    rng = np.random.default_rng(seed)
    label = rng.integers(0, labels, n)
    middles = rng.normal(0, 3, (labels, 3))
    points = middles[label] + spread * rng.standard_t(3, (n, 3))
    data = pd.DataFrame(points, columns=COLUMNS)
    data.insert(0, "id", np.arange(n))
    data["cluster"] = label.astype(np.int32)
    return spark.createDataFrame(data).repartition(6), points, label


def exact(points, label):
    marks = np.unique(label)
    value = np.zeros(len(points))
    for start in range(0, len(points), 500):
        part = slice(start, start + 500)
        away = np.sqrt(((points[part, None] - points[None]) ** 2).sum(axis=2))
        total = np.stack([away[:, label == mark].sum(axis=1) for mark in marks], axis=1)
        size = np.array([(label == mark).sum() for mark in marks])
        own = np.searchsorted(marks, label[part])
        each = np.arange(len(own))
        inner = total[each, own] / np.maximum(size[own] - 1, 1)
        means = total / size
        means[each, own] = np.inf
        outer = means.min(axis=1)
        most = np.maximum(inner, outer)
        value[part] = np.where((size[own] > 1) & np.isfinite(outer) & (most > 0), (outer - inner) / np.where(most > 0, most, 1), 0)
    return value


def got(df, **settings):
    rows = silhouette.silhouette_within(df, key="id", columns=COLUMNS, **settings)
    return rows.orderBy("id").toPandas()


@pytest.mark.parametrize(("error", "leaf"), [(0.1, 16), (0.01, 64), (0.001, 256)])
def test_the_error_is_within_the_stated_one(spark, error, leaf):
    df, points, label = table(spark, 4000)
    rows = got(df, error=error, leaf=leaf)
    assert rows["id"].tolist() == list(range(4000)) and rows["cluster"].tolist() == label.tolist()
    off = np.abs(rows["silhouette"] - exact(points, label))
    assert off.max() <= error
    assert off.max() > 0  # far nodes were taken whole


def test_points_far_from_zero_ties_and_lone_points(spark):
    rng = np.random.default_rng(0)
    points = np.vstack([1e6 + rng.normal(0, 1, (300, 3)), np.full((200, 3), 1e6), [[1e6 + 50] * 3]])
    label = np.array([0] * 150 + [5] * 350 + [9])
    data = pd.DataFrame(points, columns=COLUMNS).assign(id=range(501), cluster=label)
    rows = got(spark.createDataFrame(data), leaf=8)
    assert np.abs(rows["silhouette"] - exact(points, label)).max() <= silhouette.ERROR
    assert rows["silhouette"].iloc[-1] == 0.0


def test_missing_numbers_one_cluster_and_nothing(spark):
    df, _, _ = table(spark, 100, labels=1)
    assert got(df)["silhouette"].tolist() == [0.0] * 100
    odd = df.withColumn("a", F.when(F.col("id") == 3, F.lit(float("nan"))).when(F.col("id") != 4, F.col("a")))
    odd = odd.withColumn("cluster", F.when(F.col("id") != 5, F.col("cluster")))
    assert sorted(set(range(100)) - set(got(odd)["id"])) == [3, 4, 5]
    assert len(got(df.limit(0))) == 0


def test_work_grows_much_slower_than_pairs(spark, monkeypatch):
    """Meetings of a leaf with a node. Four times the points have sixteen times the pairs; measured
    are about seven times the meetings, and fewer as the points lie denser."""
    seen = Counter()
    store = silhouette._stored

    def counted(df, name):
        out = store(df, name)
        if name == "meetings":
            seen["meetings"] += out.count()
        return out

    monkeypatch.setattr(silhouette, "_stored", counted)
    counts = []
    for n in (16_000, 64_000):
        seen.clear()
        rng = np.random.default_rng(1)
        label = rng.integers(0, 3, n)
        points = rng.normal(0, 3, (3, 3))[label] + rng.normal(0, 1, (n, 3))
        data = pd.DataFrame(points, columns=COLUMNS).assign(id=range(n), cluster=label)
        silhouette.silhouette_within(spark.createDataFrame(data), 0.2, "id", COLUMNS, leaf=32)
        counts.append(seen["meetings"])
    assert counts[1] < 4 * 2.2 * counts[0]
    assert counts[1] < 0.25 * (64_000 / 32) ** 2
