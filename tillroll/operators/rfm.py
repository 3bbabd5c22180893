"""Recency, frequency and monetary value per customer, and their scaled features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.flags import ensure_flags, genuine_sale
from tillroll.functions.measures import line_value
from tillroll.sources.tables import MONTH

SCALED = ("scaled_recency_days", "scaled_log_frequency", "scaled_log_monetary")


def last_invoice(facts: DataFrame) -> DataFrame:
    """One row, one column: the last moment of the table, whoever bought.

    Where facts are kept in folders by month, only the last folder's dates are read.
    """
    recent = facts
    if MONTH in facts.columns:
        recent = facts.filter(F.col(MONTH) == facts.agg(F.max(MONTH)).scalar())
    return recent.agg(F.max("invoice_date").alias("last"))


def rfm(facts: DataFrame) -> DataFrame:
    """One row per customer with a genuine sale.

    Recency counts calendar days back from the last invoice of the whole table, whoever made it.
    The distinct count is planned by (customer, invoice) first, so a customer holding much of the
    table is spread over tasks and reaches the final step as partial sums.
    """
    last_day = last_invoice(facts).scalar()
    return (
        ensure_flags(facts)
        .filter(genuine_sale())
        .groupBy("customer_id")
        .agg(
            F.max("invoice_date").alias("last_sale"),
            F.count_distinct(F.upper("invoice_no")).alias("frequency"),
            F.sum(line_value()).alias("monetary"),
        )
        .select(
            "customer_id",
            F.datediff(last_day, "last_sale").alias("recency_days"),
            "frequency",
            "monetary",
        )
    )


def log_features(customers: DataFrame) -> DataFrame:
    """Logarithms of the two skewed measures."""
    spent = F.col("monetary").cast("double")
    return customers.withColumns(
        {
            "log_frequency": F.log1p(F.col("frequency").cast("double")),
            "log_monetary": F.log1p(F.greatest(spent, F.lit(0.0))),
        }
    )


def scaled_features(customers: DataFrame) -> DataFrame:
    """Log features, then each of the three to mean 0 and population deviation 1.

    A constant column scales to 0. The statistics are one row, read as a scalar subquery.
    """
    logged = log_features(customers)
    sources = [name.removeprefix("scaled_") for name in SCALED]
    stats = logged.agg(
        F.struct(
            *[
                F.struct(
                    F.avg(name).alias("mean"),
                    F.stddev_pop(name).alias("std"),
                    (F.min(name) == F.max(name)).alias("constant"),
                ).alias(name)
                for name in sources
            ]
        ).alias("stats")
    ).scalar()

    def scale(name: str) -> Column:
        column = stats[name]
        return F.when(column["constant"], F.lit(0.0)).otherwise(
            (F.col(name) - column["mean"]) / column["std"]
        )

    return logged.withColumns(
        {scaled: scale(name) for scaled, name in zip(SCALED, sources)}
    )
