"""Joint K-Means against plain numpy."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import functions as F

from tillroll.operators import clustering, lloyd, rfm

COLUMNS = ["a", "b", "c"]


def table(spark, n=3000, seed=1, repeated=0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 3, (5, 3))
    points = middles[rng.integers(0, 5, n)] + rng.standard_t(3, (n, 3))
    points = np.vstack([points, np.repeat(points[:1], repeated, axis=0)])
    data = pd.DataFrame(points, columns=COLUMNS)
    data.insert(0, "id", np.arange(len(data)))
    return spark.createDataFrame(data), points


def plain_step(points, centres):
    away = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
    label = away.argmin(axis=1)
    after = np.array([points[label == i].mean(axis=0) if (label == i).any() else c for i, c in enumerate(centres)])
    return after, label, away[np.arange(len(points)), label].sum()


def plain_fit(points, centres, tolerance):
    for step in range(1, 301):
        after, _, _ = plain_step(points, centres)
        moved = math.sqrt(((after - centres) ** 2).sum(axis=1).max())
        centres = after
        if moved <= tolerance:
            return centres, step
    return centres, 300


@pytest.mark.parametrize("cell", [1, 16, 128])
def test_all_models_move_as_each_would_alone(spark, cell):
    df, points = table(spark, repeated=500)
    cells = lloyd.cells_of(df, COLUMNS, cell)
    assert cells.table.select(F.sum(F.size("points"))).first()[0] == 3 * len(points)
    centres = [lloyd.first_centres(points, k, start, 7) for k in (1, 2, 5, 8) for start in range(3)]
    for own, (after, sizes) in zip(centres, lloyd.lloyd_step(cells, centres), strict=True):
        want, label, _ = plain_step(points, own)
        np.testing.assert_allclose(after, want, atol=1e-8)
        assert sizes == np.bincount(label, minlength=len(own)).tolist()
    for own, (after, steps) in zip(centres, lloyd.fit_from(cells, centres, 1e-4), strict=True):
        want, want_steps = plain_fit(points, own, 1e-4)
        np.testing.assert_allclose(after, want, atol=1e-7)
        assert steps == want_steps


def test_models_are_the_same_under_any_partitioning(spark, monkeypatch):
    df, points = table(spark)
    fits = [lloyd.fit_models(df.repartition(n), [2, 4, 6], 3, 5, "id", COLUMNS) for n in (1, 7)]
    monkeypatch.setattr(lloyd, "POINTS_PER_PARTITION", 100)
    monkeypatch.setattr(lloyd, "FEW_TASKS", 1)  # and when sums are aggregated first
    fits.append(lloyd.fit_models(df.repartition(40), [2, 4, 6], 3, 5, "id", COLUMNS))
    for other in fits[1:]:
        for a, b in zip(fits[0], other, strict=True):
            assert (a.centres == b.centres).all() and a.cost == b.cost and a.sizes == b.sizes
    for model in fits[0]:
        _, label, cost = plain_step(points, model.centres)
        assert model.sizes == np.bincount(label, minlength=model.k).tolist()
        assert math.isclose(model.cost, cost, rel_tol=1e-9)
    for best in lloyd.cheapest(fits[0]):
        assert best.cost == min(model.cost for model in fits[0] if model.k == best.k)


def test_whole_cells_are_settled_without_their_points(spark):
    """Well apart and compact: no squared distance of a single point is taken."""
    rng = np.random.default_rng(0)
    points = np.vstack([rng.normal(m, 0.01, (1000, 3)) for m in (0.0, 50.0)])
    df = spark.createDataFrame(pd.DataFrame(points, columns=COLUMNS).assign(id=range(2000)))
    cells = lloyd.cells_of(df, COLUMNS)
    blocks = [
        block
        for batch in cells.table.toArrow().to_batches()
        for block in lloyd._blocks(batch, 3)
    ]
    radius = np.concatenate([block.radius for block in blocks])
    assert np.mean(radius < 1) > 0.8
    (after, sizes), = lloyd.lloyd_step(cells, [np.array([[1.0, 0, 0], [49.0, 50, 50]])])
    assert sizes == [1000, 1000]
    np.testing.assert_allclose(after, [points[:1000].mean(axis=0), points[1000:].mean(axis=0)], atol=1e-9)


def test_squared_silhouettes_are_those_of_the_evaluator(spark):
    df, points = table(spark, n=800)
    cells = lloyd.cells_of(df, COLUMNS)
    models = lloyd.cheapest(lloyd.fit_models(df, [2, 3, 6], 2, 5, "id", COLUMNS, cells))
    got = lloyd.squared_silhouettes(cells, [model.centres for model in models])
    vectors = clustering.feature_vectors(df, "id", COLUMNS)
    evaluator = ClusteringEvaluator(predictionCol="cluster", featuresCol="features")
    for model, value in zip(models, got, strict=True):
        labelled = clustering.assign_to_centroids(vectors, list(enumerate(model.centres.tolist())), COLUMNS)
        assert math.isclose(value, evaluator.evaluate(labelled), abs_tol=1e-9)
    alone = np.vstack([points.mean(axis=0), [[1e3, 1e3, 1e3]]])
    assert lloyd.squared_silhouettes(cells, [points[:1], alone]) == [0.0, 0.0]


def test_rows_without_numbers_and_empty_tables(spark):
    rows = [(1, 0.0, 0.0, 0.0), (2, None, 1.0, 1.0), (3, float("nan"), 1.0, 1.0), (4, float("inf"), 0.0, 0.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    for model in lloyd.fit_models(df, [1, 3], 2, 5, "id", COLUMNS):
        assert model.centres.tolist() == [[0.0, 0.0, 0.0]] and model.sizes == [1] and model.cost == 0.0
    for model in lloyd.fit_models(df.limit(0), [2], 1, 5, "id", COLUMNS):
        assert model.sizes == [] and model.cost == 0.0
    schema = "customer_id long, monetary double, " + ", ".join(f"{name} double" for name in rfm.SCALED)
    nobody = spark.createDataFrame([], schema)
    assert clustering.fit_clusters(nobody).collect() == []


def test_one_huge_value_keeps_the_others_apart(spark):
    points = np.array([[0.0, 0, 0], [1.0, 0, 0], [1e9, 0, 0]] * 10)
    df = spark.createDataFrame(pd.DataFrame(points, columns=COLUMNS).assign(id=range(30)))
    (model,) = lloyd.cheapest(lloyd.fit_models(df, [3], 4, 5, "id", COLUMNS))
    assert sorted(model.sizes) == [10, 10, 10]
