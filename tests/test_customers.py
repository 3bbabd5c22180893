from datetime import datetime
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from helpers import facts_of, sale
from pyspark.sql import functions as F

from tillroll.functions.flags import with_flags
from tillroll.operators import clustering, rfm, segments
from tillroll.sources import testtables


def customers(spark, rows):
    return spark.createDataFrame(
        rows, "customer_id int, recency_days int, frequency long, monetary double, cluster int"
    )


def test_recency_counts_from_the_last_row_of_the_table(spark):
    rows = facts_of(
        spark,
        sale(1, invoice_no="a1", invoice_date=datetime(2010, 6, 1, 23)),
        sale(2, invoice_no="A1", invoice_date=datetime(2010, 6, 1, 23)),
        sale(3, invoice_no="b2", invoice_date=datetime(2010, 5, 1)),
        # neither of these is a genuine sale, yet the first sets the day recency counts from
        sale(4, customer_id=None, invoice_date=datetime(2010, 6, 11, 1)),
        sale(5, invoice_no="C3", quantity=-9),
    )
    got = rfm.rfm(rows).first()
    assert (got.recency_days, got.frequency, got.monetary) == (10, 2, Decimal("9.00"))
    assert rfm.rfm(with_flags(rows)).first() == got


def test_a_constant_feature_scales_to_zero(spark):
    one = customers(spark, [(7, 3, 2, 9.5, 0)])
    assert [rfm.scaled_features(one).first()[name] for name in rfm.SCALED] == [0.0, 0.0, 0.0]
    rows = customers(spark, [(i, i, 4, 0.1, 0) for i in range(10)])
    got = rfm.scaled_features(rows).toPandas()
    assert (got["scaled_log_monetary"] == 0).all()
    assert got["scaled_recency_days"].std(ddof=0) == pytest.approx(1)


def test_negative_spend_counts_as_none(spark):
    rows = customers(spark, [(1, 1, 1, -5.0, 0)])
    assert rfm.log_features(rows).first().log_monetary == 0.0


# Cluster 0 is the one named; cluster 1 holds the customers that set the medians (R 50, F 5, M 100).
@pytest.mark.parametrize(
    ("recency", "frequency", "monetary", "name"),
    [
        (10, 9, 500.0, "Champions"),
        (50, 5, 100.0, "Champions"),
        (90, 1, 10.0, "Lost / Lapsed"),
        (10, 1, 10.0, "New / Low-Engagement"),
        (90, 9, 10.0, "Occasional / Low-value"),
        (90, 1, 500.0, "Occasional / Low-value"),
        (90, 9, 500.0, "Occasional / Low-value"),
        (10, 9, 10.0, "Regular"),
        (10, 1, 500.0, "Regular"),
    ],
)
def test_every_name(spark, recency, frequency, monetary, name):
    rows = [(1, recency, frequency, monetary, 0)]
    rows += [(i, 50, 5, 100.0, 1) for i in range(2, 7)]
    got = segments.cluster_names(customers(spark, rows)).filter("cluster = 0").first()
    assert got.segment_name == name


def test_clusters_with_one_name_are_one_segment(spark):
    rows = customers(spark, [(1, 1, 1, 10.0, 0), (2, 2, 2, 20.0, 1), (3, 3, 4, 40.0, 1)])
    named = rows.withColumns(
        {"segment_name": F.lit("Regular"), "monetary": F.col("monetary").cast("decimal(12,2)")}
    )
    got = segments.segment_stats(named).collect()
    assert len(got) == 1 and got[0].customer_count == 3
    assert str(got[0].avg_frequency) == "2.3" and str(got[0].avg_monetary) == "23.33"
    assert segments.segment_profile(named).count() == 2
    assert segments.segment_shares(named).first().pct_of_customers == 100.0


def blobs(spark, n=60, seed=3):
    rng = np.random.default_rng(seed)
    centres = np.array([[0, 0, 0], [6, 0, 0], [0, 6, 6]])
    points = np.vstack([c + rng.normal(0, 0.6, (n, 3)) for c in centres])
    data = pd.DataFrame(points, columns=list(rfm.SCALED))
    data.insert(0, "customer_id", np.arange(len(data)))
    data["truth"] = np.repeat([0, 1, 2], n)
    data["monetary"] = np.repeat([10.0, 30.0, 20.0], n)
    return spark.createDataFrame(data)


def test_fit_finds_the_clusters_and_orders_them_by_spend(spark):
    rows = blobs(spark)
    fitted = clustering.fit_clusters(rows, k=3, starts=3).toPandas()
    assert fitted.groupby("truth")["cluster"].nunique().eq(1).all()
    assert fitted.groupby("truth")["cluster"].first().tolist() == [2, 0, 1]


def test_fit_does_not_depend_on_partitioning(spark):
    rows = blobs(spark)
    labels = [
        clustering.fit_clusters(rows.repartition(n), k=3, starts=2)
        .orderBy("customer_id")
        .toPandas()["cluster"]
        .tolist()
        for n in (1, 7)
    ]
    assert labels[0] == labels[1]


def test_points_go_to_their_nearest_centre_and_more_starts_cost_no_more(spark):
    rows = blobs(spark)
    one = clustering.best_of_starts(rows, 4, starts=1).cost
    best = clustering.best_of_starts(rows, 4, starts=4).cost
    assert best <= one
    fitted = clustering.fit_clusters(rows, k=4, starts=1)
    centres = np.array([c for _, c in clustering.centroids_of(fitted)])
    data = fitted.toPandas()
    points = data[list(rfm.SCALED)].to_numpy()
    distance = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
    own = distance[np.arange(len(data)), data["cluster"]]
    assert (own <= distance.min(axis=1) + 0.05).all()


def test_assignment_breaks_ties_by_label(spark):
    rows = spark.createDataFrame([(0.0, 0.0, 0.0)], list(rfm.SCALED))
    got = clustering.assign_to_centroids(rows, [(5, [1, 0, 0]), (2, [-1, 0, 0])])
    assert got.first().cluster == 2
    assert clustering.assign_to_centroids(rows, [(9, [1, 1, 1])]).first().cluster == 9


def brute_silhouette(points, labels):
    out = []
    for i, point in enumerate(points):
        distance = np.sqrt(((points - point) ** 2).sum(axis=1))
        means = {c: distance[labels == c] for c in np.unique(labels)}
        own = means.pop(labels[i])
        if len(own) == 1 or not means:
            out.append(0.0)
            continue
        a, b = own.sum() / (len(own) - 1), min(m.mean() for m in means.values())
        out.append((b - a) / max(a, b))
    return np.array(out)


def test_silhouette_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    data = blobs(spark, n=25).toPandas()
    data["cluster"] = rng.integers(0, 3, len(data))
    data.loc[0, "cluster"] = 7  # alone
    rows = spark.createDataFrame(data).repartition(5)
    got = clustering.euclidean_silhouette(rows).orderBy("customer_id").toPandas()["silhouette"]
    want = brute_silhouette(data[list(rfm.SCALED)].to_numpy(), data["cluster"].to_numpy())
    np.testing.assert_allclose(got, want, atol=1e-12)


def test_silhouette_does_not_depend_on_blocks_or_size(spark):
    rows = blobs(spark, n=100).withColumn("cluster", F.col("truth").cast("int"))
    whole = clustering.euclidean_silhouette(rows).orderBy("customer_id").toPandas()
    cut = clustering.euclidean_silhouette(rows, block=70).orderBy("customer_id").toPandas()
    assert len(whole) == 300
    np.testing.assert_allclose(whole["silhouette"], cut["silhouette"], atol=1e-12)


def test_sweep_prefers_the_true_number(spark):
    sweep = clustering.k_sweep(blobs(spark, n=30), k_range=(2, 3, 4), starts=2, euclidean=True).toPandas()
    assert sweep["k"].tolist() == [2, 3, 4]
    assert sweep["inertia"].is_monotonic_decreasing
    assert sweep.loc[sweep["silhouette"].idxmax(), "k"] == 3
    assert sweep.loc[sweep["silhouette_squared"].idxmax(), "k"] == 3


def test_sweep_within_an_error(spark):
    rows = blobs(spark, n=30)
    sweeps = [
        clustering.k_sweep(rows, k_range=(3,), starts=1, euclidean=True, error=error).first().silhouette
        for error in (None, 0.02)
    ]
    assert abs(sweeps[0] - sweeps[1]) <= 0.02


def test_segment_counts_add_up(spark, sf):
    table = testtables.segments(spark, sf)
    assert table.count() == 120
    total = segments.segment_shares(table).agg(F.sum("customer_count")).first()[0]
    assert total == 120
