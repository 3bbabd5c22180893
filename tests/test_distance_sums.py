"""Sums of distances by boxes and grids against all pairs, and the silhouette over them."""

import math

import numpy as np
import pandas as pd
import pytest

from tillroll.operators import clustering, distance_sums
from tillroll.operators.rfm import SCALED


def wanted(points, others, marks, labels):
    away = np.sqrt(((points[:, None].astype(np.longdouble) - others[None]) ** 2).sum(axis=2))
    return np.stack([away[:, marks == label].sum(axis=1) for label in range(labels)], axis=1).astype(float)


def cloud(n, seed, axes=3, labels=3):
    rng = np.random.default_rng(seed)
    points = rng.normal(0, 1, (n, axes)) * [4.0, 1.0, 0.5][:axes]
    points[: n // 3, -1] = np.round(points[: n // 3, -1])  # on planes, as counts are
    return points, rng.integers(-1, labels, n)


@pytest.mark.parametrize("axes", [1, 2, 3])
@pytest.mark.parametrize("labels", [3, 40])
def test_sums_are_those_of_all_pairs(axes, labels):
    one, mark = cloud(9_000, 0, axes, labels)
    two, other = cloud(5_000, 1, axes, labels)
    two += 3
    within = distance_sums.distance_sums([one], [mark], labels, 256)[0]
    some = slice(0, 9_000, 60)
    np.testing.assert_allclose(within[some], wanted(one[some], one, mark, labels), rtol=1e-12)
    here, there = distance_sums.distance_sums([one, two], [mark, other], labels, 256)
    np.testing.assert_allclose(here[some], wanted(one[some], two, other, labels), rtol=1e-12)
    np.testing.assert_allclose(there[:100], wanted(two[:100], one, mark, labels), rtol=1e-12)


def test_pairs_looked_at_grow_much_slower_than_pairs(monkeypatch):
    seen = []
    made = distance_sums._distances

    def counted(mine, others):
        seen.append(len(mine) * len(others))
        return made(mine, others)

    monkeypatch.setattr(distance_sums, "_distances", counted)
    work = []
    for n in (10_000, 40_000):
        seen.clear()
        points, mark = cloud(n, 2, 2)
        distance_sums.distance_sums([points], [mark], 3, 256)
        work.append(sum(seen))
    assert work[1] < 7 * work[0]
    assert work[1] < 0.1 * 40_000**2


def test_grids_are_read_off_before_they_grow_large(monkeypatch):
    points, mark = cloud(6_000, 3)
    whole = distance_sums.distance_sums([points], [mark], 3, 128)[0]
    monkeypatch.setattr(distance_sums, "KEPT", 1)
    np.testing.assert_allclose(distance_sums.distance_sums([points], [mark], 3, 128)[0], whole, rtol=1e-12)


def test_points_far_off_close_together_equal_and_without_a_place():
    rng = np.random.default_rng(4)
    points = np.vstack(
        [rng.normal(0, 1e-6, (300, 3)), rng.normal(1e6, 1, (300, 3)), np.zeros((400, 3)), [[1e200] * 3]]
    )
    mark = rng.integers(0, 2, len(points))
    with np.errstate(over="ignore", invalid="ignore"):
        got = distance_sums.distance_sums([points], [mark], 2, 64)[0]
        assert np.isinf(got[:, mark[-1]]).all()
    kept, mark = points[:-1], mark[:-1]
    got = distance_sums.distance_sums([kept], [mark], 2, 64)[0]
    np.testing.assert_allclose(got, wanted(kept, kept, mark, 2), rtol=1e-12)
    odd = kept.copy()
    odd[5, 1], odd[7, 0] = math.nan, math.inf
    mark[[5, 7]] = 0, 1
    with np.errstate(invalid="ignore"):
        got = distance_sums.distance_sums([odd], [mark], 2, 64)[0]
    assert np.isnan(got[5]).all() and np.isnan(got[:, mark[5]]).all()
    assert np.isinf(np.delete(got[:, 1], [5, 7])).all() and np.isnan(got[7]).all()


def test_silhouette_over_several_groups(spark, monkeypatch):
    """Repeated and null keys, points without a label, text labels."""
    monkeypatch.setattr(clustering, "GROUPS", 10)
    points, mark = cloud(3_000, 5)
    data = pd.DataFrame(points, columns=list(SCALED))
    data["cluster"] = [None if label < 0 else "xyz"[label] for label in mark]
    data["customer_id"] = [f"c{i}" for i in range(3_000)]
    rows = clustering.euclidean_silhouette(spark.createDataFrame(data), block=50)
    got = rows.toPandas().set_index("customer_id").loc[data["customer_id"]]
    assert len(got) == 3_000
    known = mark >= 0
    sums = wanted(points, points, mark, 3)
    sizes = np.bincount(mark[known], minlength=3)
    means = sums / sizes
    each = np.arange(3_000)
    inner = sums[each, mark] / (sizes[mark] - 1)
    means[each, mark] = math.inf
    outer = means.min(axis=1)
    want = np.where(known, (outer - inner) / np.maximum(inner, outer), 0.0)
    np.testing.assert_allclose(got["silhouette"], want, atol=1e-12)
    assert got["cluster"].isna().tolist() == (~known).tolist()


def test_silhouette_of_repeated_keys_counts_their_points(spark):
    rows = [(1, 0, 0.0), (1, 0, 2.0), (None, 0, 3.0), (2, 1, 9.0), (None, 1, 11.0)]
    frame = spark.createDataFrame([(k, c, x, 0.0, 0.0) for k, c, x in rows], ["customer_id", "cluster", *SCALED])
    got = {tuple(row)[:2]: row["silhouette"] for row in clustering.euclidean_silhouette(frame).collect()}
    # Two rows of a key are one: sums of both, over the points of both, itself left out once.
    inner, outer = (2 + 3 + 2 + 1) / 5, (9 + 11 + 7 + 9) / 4
    assert got[1, 0] == pytest.approx((outer - inner) / outer, abs=1e-12)
    assert set(got) == {(1, 0), (None, 0), (2, 1), (None, 1)}
    assert clustering.euclidean_silhouette(frame.limit(0)).count() == 0
