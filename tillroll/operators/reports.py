"""Report tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.grouping import group_text, text_order
from tillroll.functions.measures import line_value
from tillroll.operators.views import revenue_transactions
from tillroll.sources.tables import in_days


def daily_revenue(facts: DataFrame) -> DataFrame:
    """Orders and revenue by day."""
    return (
        revenue_transactions(facts)
        .groupBy(F.to_date("invoice_date").alias("invoice_date"))
        .agg(
            F.count_distinct(F.upper("invoice_no")).alias("order_count"),
            F.sum(line_value()).alias("revenue"),
        )
        .orderBy("invoice_date")
    )


def monthly_revenue(facts: DataFrame) -> DataFrame:
    """Orders and revenue by calendar month."""
    return (
        revenue_transactions(facts)
        .groupBy(F.trunc("invoice_date", "month").alias("invoice_month"))
        .agg(
            F.count_distinct(F.upper("invoice_no")).alias("order_count"),
            F.sum(line_value()).alias("revenue"),
        )
        .orderBy("invoice_month")
    )


def top_products(facts: DataFrame, limit: int = 20) -> DataFrame:
    """Products by revenue; equal revenue in order of their names."""
    keys = ["stock_code", "description"]
    return (
        group_text(
            revenue_transactions(facts),
            keys,
            {"units_sold": F.col("quantity"), "revenue": line_value()},
        )
        .orderBy(F.desc("revenue"), *text_order(*keys))
        .limit(limit)
    )


def headline_figures(facts: DataFrame, scores: DataFrame, top_n: int = 20) -> DataFrame:
    """One row of headline figures.

    Orders are counted over the whole table: an invoice that spans two days is one order.
    ``products_tracked`` is the length of the top-products report.
    """
    flagged = scores.agg(F.count_if("is_anomaly").alias("n")).scalar()
    rows = revenue_transactions(facts)
    # Each count reads its own columns and combines before it shuffles; counted in one aggregate, every
    # row would be repeated for each of them.
    products = (
        rows.select(F.upper("stock_code").alias("code"), F.upper("description").alias("description"))
        .distinct()
        .agg(F.count("*").alias("products"), F.count_distinct("code").alias("codes"))
    )
    customers = rows.select("customer_id").distinct().agg(F.count("customer_id").alias("n")).scalar()
    return (
        rows.groupBy(F.upper("invoice_no").alias("invoice"))
        .agg(F.sum(line_value()).alias("value"))
        .agg(F.sum("value").alias("total_revenue"), F.count("invoice").alias("total_orders"))
        .withColumn("distinct_customers", customers)
        .withColumn("distinct_products", products.select("codes").scalar())
        .withColumn("products_tracked", F.least(products.select("products").scalar(), F.lit(top_n)))
        .withColumn("anomalies_flagged", flagged)
    )


def sliced(facts: DataFrame, first: str | date, last: str | date) -> DataFrame:
    """Facts of the days ``first`` to ``last``; any report above can be run on the result."""
    return in_days(facts, first, last)
