"""What the physical plans must and must not contain."""

import re

import pytest

from contract.queries import QUERIES
from tillroll.operators import anomalies, reports, rfm, views
from tillroll.sources import testtables

# These run jobs while they are built: fits, exports and reruns.
EAGER = {"r4_k_sweep", "r6_kmeans_segments", "a4_anomaly_scores", "s6_append_twice"}


def plan(df) -> str:
    """The physical plan, with no part of a scan's description cut short."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_joins(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_flag_filters_reach_the_scan(spark, sf):
    text = plan(views.revenue_transactions(testtables.facts(spark, sf)))
    pushed = text[text.index("PushedFilters") :]
    for flag in ("is_non_product", "is_invalid_price", "is_stock_adjustment"):
        assert f"EqualTo({flag},true)" in pushed


def test_only_named_columns_are_read(spark, sf):
    text = plan(reports.monthly_revenue(testtables.facts(spark, sf)))
    schema = text[text.index("ReadSchema") :]
    assert "invoice_no" in schema and "unit_price" in schema
    assert "country" not in schema and "description" not in schema and "customer_id" not in schema


def test_facts_are_hash_aggregated_by_spelling_first(spark, sf):
    text = plan(views.net_sales(testtables.facts(spark, sf)))
    below = text[text.index("HashAggregate(keys=[stock_code") :]
    assert "SortAggregate" not in below
    assert "partial_sum" in below


def test_distinct_invoices_are_spread_before_they_meet_at_the_customer(spark, sf):
    text = plan(rfm.rfm(testtables.facts(spark, sf)))
    assert text.count("Exchange hashpartitioning") == 2
    first = text[text.rindex("Exchange hashpartitioning") :].split("\n")[0]
    assert "customer_id" in first and "upper(invoice_no" in first


def test_the_last_day_is_read_from_the_last_month(spark, sf):
    facts = testtables.facts(spark, sf)
    last = rfm.last_invoice(facts)
    assert last.first()[0] == rfm.last_invoice(facts.drop("invoice_month")).first()[0]
    assert "PartitionFilters: [isnotnull(invoice_month" in plan(last)


def test_date_slices_skip_months(spark, sf):
    text = plan(reports.daily_revenue(reports.sliced(testtables.facts(spark, sf),
                                                     "1995-03-15", "1995-04-02")))
    filters = text[text.index("PartitionFilters") :].split("\n")[0]
    assert "1995-03-01" in filters and "1995-04-01" in filters


def test_top_products_keeps_only_the_top_while_sorting(spark, sf):
    assert "TakeOrderedAndProject" in plan(reports.top_products(testtables.facts(spark, sf)))


def test_unflagged_facts_are_not_moved(spark, sf):
    """With broadcasts off: months without flagged facts are not read, and of the others only facts
    that may be flagged pass the scan's filter."""
    facts, scores = testtables.facts(spark, sf), testtables.scores(spark, sf)
    flagged = scores.filter("is_anomaly")
    months = flagged.select("invoice_month").distinct().count()
    assert 0 < months < facts.select("invoice_month").distinct().count()
    passing, _ = anomalies.flagged_facts(facts, scores)
    assert flagged.count() <= passing.count() <= 1.05 * flagged.count() + 5
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (
            anomalies.flagged_detail(facts, scores),
            anomalies.top_flagged_customers(facts, scores),
            anomalies.customer_concentration(facts, scores),
        ):
            text = plan(df)
            scan = next(line for line in text.split("\n") if "customer_id" in line and "FileScan" in line)
            filters = scan[scan.index("PartitionFilters") : scan.index("PushedFilters")]
            assert len(re.findall(r"\d{4}-\d\d-01", filters)) == months
            above = text[: text.index(scan)]
            # Between the scan and the join's exchange stands the filter.
            below = above[above.rindex("Exchange hashpartitioning(id") :]
            assert "Filter" in below and "xxhash64(id" in below and "Subquery" in below
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
