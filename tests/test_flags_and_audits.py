from datetime import datetime
from decimal import Decimal

from helpers import facts_of, narratives_of, sale
from pyspark.sql import functions as F

from tillroll.functions.flags import genuine_sale, with_flags
from tillroll.operators import quality, reports, views
from tillroll.schema import CUSTOMER_SEGMENTS, TRANSACTION_ANOMALIES
from tillroll.sources import testtables


def test_flags_ignore_case(spark):
    rows = with_flags(
        facts_of(
            spark,
            sale(1, invoice_no="c1", quantity=-1),
            sale(2, stock_code="bank Charges"),
            sale(3, quantity=-4),
            sale(4, unit_price=Decimal("0.00"), customer_id=None),
        )
    )
    got = {r.id: r for r in rows.collect()}
    assert got[1].is_cancellation and got[1].is_return and not got[1].is_stock_adjustment
    assert got[2].is_non_product
    assert got[3].is_stock_adjustment and not got[3].is_cancellation
    assert got[4].is_invalid_price and got[4].is_missing_customer
    assert [r.id for r in rows.filter(genuine_sale()).collect()] == [2]


def test_flag_invariants_on_the_test_table(spark, sf):
    facts = testtables.facts(spark, sf)
    row = facts.agg(
        F.count_if("is_return").alias("returns"),
        F.count_if("is_stock_adjustment").alias("adjustments"),
        F.count_if(F.col("is_cancellation") & F.col("is_return")).alias("cancelled"),
        F.count("*").alias("rows"),
    ).first()
    assert row.returns == row.adjustments + row.cancelled
    assert row.rows == testtables.transactions(spark, sf).count() == 6016
    v1, v2 = views.revenue_transactions(facts), views.customer_transactions(facts)
    assert v2.join(v1, "id", "left_anti").count() == 0
    assert v1.join(facts, "id", "left_anti").count() == 0


def test_revenue_adds_up_over_views(spark, sf):
    facts = testtables.facts(spark, sf)
    sums = [
        views.net_sales(facts).agg(F.sum("net_revenue")).first()[0],
        reports.daily_revenue(facts).agg(F.sum("revenue")).first()[0],
        reports.monthly_revenue(facts).agg(F.sum("revenue")).first()[0],
    ]
    assert sums[0] == sums[1] == sums[2]


def test_products_that_differ_in_case_are_one(spark):
    rows = facts_of(
        spark,
        sale(1, stock_code="85123a", description=None),
        sale(2, stock_code="85123A", description=None),
        sale(3, stock_code="85123A", description="Mug"),
        sale(4, stock_code="85123A", description="MUG", quantity=-1, invoice_no="C9"),
    )
    got = {r.description: r for r in views.net_sales(rows).collect()}
    assert got[None].net_quantity == 4 and got[None].stock_code == "85123A"
    assert got["MUG"].net_quantity == 1 and got["MUG"].net_revenue == Decimal("1.50")


def test_summary_of_an_empty_table(spark):
    got = {r.metric: r for r in quality.cleaning_summary(facts_of(spark)).collect()}
    assert got["total_rows"]["count"] == 0 and got["total_rows"].pct_of_total == 100.0
    assert got["negative_quantity"].pct_of_total is None


def test_summary_rounds_halves_to_even(spark):
    rows = [sale(i, quantity=-1 if i == 0 else 1) for i in range(800)]
    got = {r.metric: r for r in quality.cleaning_summary(facts_of(spark, *rows)).collect()}
    assert got["negative_quantity"].pct_of_total == 0.12  # 0.125


def test_duplicates_count_nulls_and_case_as_equal(spark):
    rows = facts_of(
        spark,
        sale(1, description=None, country=None),
        sale(2, description=None, country=None, invoice_no="500001"),
        sale(3, description=""),
        sale(4, stock_code="m"),
        sale(5, stock_code="M"),
        sale(6, quantity=9),
    )
    got = quality.exact_duplicates(rows).collect()
    assert sorted((r.stock_code, r.occurrences) for r in got) == [("10001", 2), ("M", 2)]


def test_one_row_holding_most_of_the_table(spark):
    rows = facts_of(spark, *[sale(i) for i in range(500)], sale(500, quantity=1))
    got = quality.exact_duplicates(rows).collect()
    assert [r.occurrences for r in got] == [500]


def test_ties_are_broken_by_key(spark):
    rows = facts_of(spark, *[sale(i, quantity=-5) for i in range(40, 0, -1)])
    assert quality.stock_adjustment_rows(rows, 3).count() == 3
    late = datetime(2012, 1, 1)
    rows = facts_of(spark, *[sale(i, invoice_date=late) for i in range(9, 0, -1)])
    got = quality.outside_window(rows, "2010-01-01", "2011-12-31", 4)
    assert sorted(r.id for r in got.collect()) == [1, 2, 3, 4]


def test_constraint_audit_finds_each_violation(spark):
    facts = facts_of(spark, sale(1), sale(1), sale(2))
    segments = spark.createDataFrame(
        [(7, 1, 1, Decimal(1), 0, "a"), (7, 1, 1, Decimal(1), 0, "a")], CUSTOMER_SEGMENTS
    )
    scores = spark.createDataFrame(
        [(1, Decimal(0), False), (9, Decimal(0), False), (9, Decimal(0), False)],
        TRANSACTION_ANOMALIES,
    )
    texts = narratives_of(
        spark, (1, "executive", None, "{}", "", None), (2, "executive", None, "{}", "", None)
    )
    got = {r.rule: r.violations for r in
           quality.constraint_audit(facts, segments, scores, texts).collect()}
    assert got["transactions id unique"] == 1
    assert got["transaction_anomalies transaction_id unique"] == 1
    assert got["transaction_anomalies transaction_id references transactions"] == 2
    assert got["customer_segments customer_id unique"] == 1
    assert got["narratives (type, key) unique"] == 1
    assert got["quantity not null"] == 0


def test_invoice_over_two_days_is_one_order_in_the_headline(spark):
    rows = facts_of(
        spark,
        sale(1, invoice_no="a1", invoice_date=datetime(2010, 6, 1, 23)),
        sale(2, invoice_no="A1", invoice_date=datetime(2010, 6, 2, 1)),
    )
    scores = spark.createDataFrame([(1, Decimal(0), True)], TRANSACTION_ANOMALIES)
    figures = reports.headline_figures(rows, scores).first()
    assert figures.total_orders == 1 and figures.anomalies_flagged == 1
    assert [r.order_count for r in reports.daily_revenue(rows).collect()] == [1, 1]
    assert reports.sliced(rows, "2010-06-02", "2010-06-02").count() == 1
