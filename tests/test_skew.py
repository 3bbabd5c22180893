"""One key holding a third of all rows changes nothing in the results."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillroll.functions.flags import with_flags
from tillroll.operators import anomalies, narratives, quality, reports, rfm, views

ROWS = 30_000


@pytest.fixture(scope="module")
def facts(spark):
    row = F.col("id")
    hot = row % 3 == 0
    df = spark.range(ROWS, numPartitions=6).select(
        "id",
        F.concat(F.lit("A"), (row % 997).cast("string")).alias("invoice_no"),
        F.when(hot, F.lit("hot")).otherwise((row % 50).cast("string")).alias("stock_code"),
        F.when(row % 5 != 0, F.lit("MUG")).alias("description"),
        F.when(row % 11 == 0, -1).otherwise(row % 7 + 1).cast("int").alias("quantity"),
        F.timestamp_add(
            "HOUR",
            F.when(hot, 5).otherwise(row % 2000).cast("int"),
            F.lit("2010-01-01").cast("timestamp_ntz"),
        ).alias("invoice_date"),
        ((row % 9) / 2).cast("decimal(10,2)").alias("unit_price"),
        F.when(hot, 1).otherwise(row % 400).cast("int").alias("customer_id"),
        F.lit("FRANCE").alias("country"),
    )
    return with_flags(df)


@pytest.fixture(scope="module")
def pdf(facts):
    out = facts.toPandas()
    out["unit_price"] = out["unit_price"].astype(float)
    out["value"] = out["quantity"] * out["unit_price"]
    return out


def test_rfm(facts, pdf):
    sales = pdf[
        ~pdf["is_cancellation"]
        & ~pdf["is_stock_adjustment"]
        & (pdf["quantity"] > 0)
        & (pdf["unit_price"] > 0)
    ]
    want = sales.groupby("customer_id").agg(f=("invoice_no", "nunique"), m=("value", "sum"))
    got = rfm.rfm(facts).toPandas().set_index("customer_id").sort_index()
    assert got["frequency"].tolist() == want["f"].tolist()
    assert got["monetary"].astype(float).tolist() == pytest.approx(want["m"].tolist())


def test_products_and_days(facts, pdf):
    kept = pdf[~pdf["is_invalid_price"] & ~pdf["is_stock_adjustment"] & ~pdf["is_non_product"]]
    want = kept.groupby(["stock_code", "description"], dropna=False)["quantity"].sum()
    got = views.net_sales(facts).toPandas()
    assert len(got) == len(want) and got["net_quantity"].sum() == want.sum()
    assert got["net_quantity"].max() == want.max()
    days = kept.groupby(kept["invoice_date"].dt.date)["invoice_no"].nunique()
    daily = reports.daily_revenue(facts).toPandas().set_index("invoice_date")["order_count"]
    pd.testing.assert_series_equal(
        daily.sort_index(), days.sort_index(), check_names=False, check_dtype=False
    )


def test_duplicates(facts, pdf):
    keys = ["invoice_no", "stock_code", "description", "quantity", "invoice_date", "unit_price",
            "customer_id", "country"]
    sizes = pdf.groupby(keys, dropna=False).size()
    got = quality.exact_duplicates(facts).toPandas()
    assert sorted(got["occurrences"]) == sorted(sizes[sizes > 1])


def test_flagged_customers(facts, pdf):
    scores = facts.select(
        F.col("id").alias("transaction_id"),
        F.lit(0).cast("decimal(10,6)").alias("anomaly_score"),
        (F.col("id") % 2 == 0).alias("is_anomaly"),
    )
    counts = pdf[pdf["id"] % 2 == 0].groupby("customer_id").size()
    top = anomalies.top_flagged_customers(facts, scores, 3).collect()
    assert (top[0].customer_id, top[0].anomaly_count) == (1, counts[1])


def test_histories(facts):
    history = facts.select(
        "id",
        F.lit("segment").alias("narrative_type"),
        F.when(F.col("stock_code") != "hot", F.col("stock_code")).alias("reference_key"),
        F.lit("{}").alias("input_stats"),
        F.col("id").cast("string").alias("narrative_text"),
        F.date_trunc("day", "invoice_date").cast("timestamp_ntz").alias("generated_at"),
    )
    pdf = history.toPandas()
    groups = pdf.groupby("reference_key", dropna=False)
    newest = narratives.newest_by_id(history).toPandas()
    assert sorted(newest["id"]) == sorted(groups["id"].max())
    latest = narratives.latest_narratives(history).count()
    assert latest == (pdf["generated_at"] == groups["generated_at"].transform("max")).sum()
    assert latest > ROWS // 3  # the hot key's rows all tie
