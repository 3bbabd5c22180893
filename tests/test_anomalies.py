from datetime import timedelta
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from helpers import NOON, facts_of, sale
from pyspark.sql import functions as F

from tillroll.functions.flags import genuine_sale
from tillroll.operators import anomalies
from tillroll.operators import isolation_forest as forest
from tillroll.schema import TRANSACTION_ANOMALIES
from tillroll.sources import testtables

XY = ["x", "y"]


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(0, 1, (1500, 2))
    points[:5] = [[9, 9], [-9, 8], [10, -9], [-8, -10], [12, 0]]
    data = pd.DataFrame(points, columns=XY)
    data.insert(0, "id", np.arange(len(data)))
    return spark.createDataFrame(data)


def walk(nodes, point):
    """Path length of one point in one tree, node by node."""
    by_node = nodes.set_index("node")
    node = depth = 0
    while by_node.loc[node, "feature"] >= 0:
        right = point[by_node.loc[node, "feature"]] > by_node.loc[node, "threshold"]
        node, depth = 2 * node + 1 + int(right), depth + 1
    return depth + float(forest.expected_path(by_node.loc[node, "size"]))


def test_scores_equal_a_walk_down_each_tree(spark, cloud):
    nodes = forest.fit_forest(cloud, "id", XY, trees=9, bag_size=64)
    nodes = spark.createDataFrame(nodes.toPandas())
    scored = forest.score_rows(cloud, nodes, XY, ["id"]).orderBy("id").limit(40).toPandas()
    points = cloud.orderBy("id").limit(40).toPandas()[XY].to_numpy()
    trees = [tree for _, tree in nodes.toPandas().groupby("tree")]
    want = [
        2 ** -(np.mean([walk(tree, p) for tree in trees]) / forest.expected_path(64))
        for p in points
    ]
    np.testing.assert_allclose(scored["raw_score"], want, rtol=1e-12)


def test_trees_partition_their_bags(cloud):
    nodes = forest.fit_forest(cloud, "id", XY, trees=12, bag_size=64).toPandas()
    assert sorted(nodes["tree"].unique()) == list(range(12))
    assert (nodes["bag_size"] == 64).all()
    leaves = nodes[nodes["feature"] < 0]
    assert (leaves.groupby("tree")["size"].sum() == 64).all()
    assert np.log2(nodes["node"] + 1).max() < 7


def test_partitioning_changes_nothing(spark, cloud):
    def scores(rows):
        nodes = forest.fit_forest(rows, "id", XY, trees=20)
        return forest.score_rows(rows, nodes, XY, ["id"]).orderBy("id").toPandas()

    pd.testing.assert_frame_equal(scores(cloud.repartition(1)), scores(cloud.repartition(7)))


def test_planted_points_rank_on_top(cloud):
    nodes = forest.fit_forest(cloud, "id", XY, trees=100)
    scored = forest.score_rows(cloud, nodes, XY, ["id"])
    top = scored.orderBy(F.desc("raw_score")).limit(5).toPandas()["id"]
    assert set(top) == {0, 1, 2, 3, 4}
    assert scored.agg(F.min("raw_score"), F.max("raw_score")).first()[1] < 1


def test_a_large_table_deals_each_row_to_one_tree(spark):
    rows = spark.range(40_000).withColumn("x", F.rand(1)).withColumn("y", F.rand(2))
    bags = forest.draw_bags(rows, "id", XY, trees=5, bag_size=32).toPandas()
    assert bags["key"].is_unique
    sizes = bags.groupby("tree").size()
    assert len(sizes) == 5 and (sizes >= 32).all() and (sizes < 140).all()


def test_a_small_table_is_whole_in_every_bag(spark):
    rows = spark.range(10).withColumn("x", F.col("id") * 1.0).withColumn("y", F.lit(0.0))
    nodes = forest.fit_forest(rows, "id", XY, trees=3).toPandas()
    assert (nodes["bag_size"] == 10).all()
    # a constant feature is never split on
    assert set(nodes["feature"]) <= {-1, 0}


def test_no_rows_and_one_row(spark):
    rows = spark.range(1).withColumn("x", F.lit(1.0)).withColumn("y", F.lit(1.0))
    for few in (rows, rows.filter("id < 0")):
        nodes = forest.fit_forest(few, "id", XY, trees=3)
        assert forest.score_rows(few, nodes, XY, ["id"]).count() == few.count()


def test_flagged_share_and_sign(spark, cloud):
    nodes = forest.fit_forest(cloud, "id", XY, trees=50)
    scored = spark.createDataFrame(forest.score_rows(cloud, nodes, XY, ["id"]).toPandas())
    flagged = anomalies.flag_top_share(scored).toPandas()
    assert flagged["is_anomaly"].sum() == 15
    assert (flagged["is_anomaly"] == (flagged["anomaly_score"] > 0)).all()
    again = anomalies.flag_top_share(scored.repartition(3)).toPandas()
    pd.testing.assert_frame_equal(
        flagged.sort_values("id", ignore_index=True), again.sort_values("id", ignore_index=True)
    )


def test_every_genuine_sale_is_scored(spark, sf):
    facts = testtables.facts(spark, sf)
    nodes = anomalies.fit_sales_forest(facts, trees=5)
    assert anomalies.score_sales(facts, nodes).count() == facts.filter(genuine_sale()).count()


def scores_of(spark, *rows):
    return spark.createDataFrame([(i, Decimal(str(s)), f) for i, s, f in rows],
                                 TRANSACTION_ANOMALIES)


def test_sunday_is_day_one(spark):
    sunday = NOON.replace(day=6)
    rows = facts_of(spark, sale(1, invoice_date=sunday), sale(2, invoice_date=sunday
                                                              + timedelta(days=6)))
    got = anomalies.sale_features(rows).orderBy("id").collect()
    assert [r.invoice_dow for r in got] == [1, 7] and got[0].invoice_hour == 12


def test_reports_break_ties_and_skip_guests(spark):
    rows = facts_of(
        spark,
        *[sale(i, customer_id=20 - i // 2, quantity=i, country="France") for i in range(2, 12)],
        sale(50, customer_id=None),
        sale(51, customer_id=19, country="Spain"),
    )
    scores = scores_of(
        spark, *[(i, 0.5, True) for i in range(2, 12)], (50, 0.5, True), (51, 0.9, False)
    )
    top = anomalies.top_flagged_customers(rows, scores, 2).collect()
    assert [r.customer_id for r in top] == [15, 16]
    assert str(top[0].avg_quantity) == "10.5" and str(top[0].avg_order_value) == "15.75"
    assert [r.id for r in anomalies.top_anomalies(rows, scores, 3).collect()] == [51, 2, 3]
    detail = anomalies.flagged_detail(rows, scores).collect()
    assert len(detail) == 11 and [r.transaction_id for r in detail[:2]] == [2, 3]
    share = anomalies.customer_concentration(rows, scores, 2).first()
    assert (share.top_anomalies, share.total_anomalies) == (4, 11)
    assert share.pct_of_anomalies == 36.36


def test_nothing_scored(spark):
    empty = scores_of(spark)
    assert anomalies.anomaly_overview(empty).first().pct_anomalous is None
    share = anomalies.customer_concentration(facts_of(spark), empty).first()
    assert share.top_anomalies == 0 and share.pct_of_anomalies is None


def test_one_sampling_law_at_every_size(spark):
    """Rows join trees independently, with the same chance, however large the table is."""
    for n, bag in ((400, 32), (40_000, 32)):
        rows = spark.range(n).select("id", F.lit(0.5).alias("x"), F.lit(0.5).alias("y"))
        bags = forest.draw_bags(rows, "id", XY, trees=40, bag_size=bag).toPandas()
        wanted = min(n, bag + 6 * np.sqrt(bag))
        sizes = bags.groupby("tree").size().reindex(range(40), fill_value=0)
        assert abs(sizes.mean() - wanted) < 5 * np.sqrt(wanted / 40)
        assert not bags.duplicated(["tree", "key"]).any()
        both = np.mean([
            len(set(bags[bags.tree == t].key) & set(bags[bags.tree == t + 1].key)) for t in range(39)
        ])
        assert abs(both - wanted * wanted / n) < 3


def test_height_follows_the_real_bag(spark):
    rows = spark.range(50).select("id", F.rand(1).alias("x"), F.rand(2).alias("y"))
    nodes = forest.fit_forest(rows, "id", XY, trees=5).toPandas()
    assert np.floor(np.log2(nodes["node"] + 1)).max() <= 6
