"""Unusual transactions: features, scores, the cut and the reports on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.flags import ensure_flags, genuine_sale
from tillroll.functions.measures import exact_mean, line_value, percent
from tillroll.functions.membership import KeyFilter
from tillroll.functions.quantiles import exact_quantile
from tillroll.operators.isolation_forest import fit_forest, score_rows
from tillroll.operators.views import anomaly_detail
from tillroll.sources.tables import MONTH

# Fixed value: share of genuine sales taken to be unusual.
CONTAMINATION = 0.01

FEATURES = (
    "log_quantity",
    "log_unit_price",
    "log_total_value",
    "invoice_hour",
    "invoice_dow",
)


def sale_features(facts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """What the model sees of each genuine sale; Sunday is day 1. ``keep``: further columns."""
    return (
        ensure_flags(facts)
        .filter(genuine_sale())
        .select(
            "id",
            "customer_id",
            "quantity",
            "unit_price",
            line_value().alias("total_value"),
            F.hour("invoice_date").alias("invoice_hour"),
            F.dayofweek("invoice_date").alias("invoice_dow"),
            *keep,
        )
    )


def log_features(sales: DataFrame) -> DataFrame:
    """Logarithms of the three skewed measures."""
    return sales.withColumns(
        {
            f"log_{name}": F.log1p(F.col(name).cast("double"))
            for name in ("quantity", "unit_price", "total_value")
        }
    )


def fit_sales_forest(facts: DataFrame, **settings) -> DataFrame:
    """Node table of a forest grown on the genuine sales."""
    return fit_forest(log_features(sale_features(facts)), "id", FEATURES, **settings)


def score_sales(facts: DataFrame, forest: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(id, further columns, raw_score) for every genuine sale."""
    sales = log_features(sale_features(facts, keep))
    return score_rows(sales, forest, FEATURES, ["id", *keep])


def flag_top_share(
    scored: DataFrame,
    score: str = "raw_score",
    contamination: float = CONTAMINATION,
) -> DataFrame:
    """Shift the score so that the top ``contamination`` share lies above 0, and flag it.

    Reads ``scored`` several times: hand in a stored table.
    """
    cut = exact_quantile(scored, score, 1.0 - contamination)
    shifted = F.col(score).cast("double") - F.lit(cut)
    return scored.withColumns({"anomaly_score": shifted, "is_anomaly": shifted > 0})


def score_table(flagged: DataFrame) -> DataFrame:
    """All scored rows as they are stored, with the fact's month where it was kept."""
    return flagged.select(
        F.col("id").alias("transaction_id"),
        F.col("anomaly_score").cast("decimal(10,6)").alias("anomaly_score"),
        "is_anomaly",
        *[name for name in (MONTH,) if name in flagged.columns],
    )


def flagged_facts(facts: DataFrame, scores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The facts that may be flagged, and the flagged scores: what a join of the two has to move.

    A Bloom filter of the flagged ids is tested in the scan of the facts, so the others are read and
    left where they are. Where scores carry the fact's month, only months with flagged facts are read
    (at most one value for each month comes to the driver).
    """
    flagged = scores.filter("is_anomaly")
    if MONTH in facts.columns and MONTH in scores.columns:
        months = [row[0] for row in flagged.select(MONTH).distinct().collect()]
        facts = facts.filter(F.col(MONTH).isin([month for month in months if month is not None]))
    ids = KeyFilter(flagged, "transaction_id")
    return facts.filter(ids.may_hold(F.col("id"))), flagged


def top_anomalies(facts: DataFrame, scores: DataFrame, limit: int = 50) -> DataFrame:
    """The strangest transactions, for review by hand. Picks them before joining."""
    top = scores.orderBy(F.desc("anomaly_score"), "transaction_id").limit(limit)
    return (
        anomaly_detail(facts, top)
        .orderBy(F.desc("anomaly_score"), "transaction_id")
        .select(
            F.col("transaction_id").alias("id"),
            "customer_id",
            "quantity",
            "unit_price",
            "total_value",
            "anomaly_score",
        )
    )


def flagged_detail(facts: DataFrame, scores: DataFrame) -> DataFrame:
    """Flagged transactions in full, strangest first. Only facts that may be flagged are joined."""
    return anomaly_detail(*flagged_facts(facts, scores)).orderBy(
        F.desc("anomaly_score"), "transaction_id"
    )


def anomaly_overview(scores: DataFrame) -> DataFrame:
    """One row: flagged, scored, percent."""
    return scores.agg(
        F.count_if("is_anomaly").alias("total_anomalies"),
        F.count("*").alias("total_scored"),
        percent(F.count_if("is_anomaly"), F.count("*")).alias("pct_anomalous"),
    )


def top_flagged_customers(facts: DataFrame, scores: DataFrame, limit: int = 3) -> DataFrame:
    """Customers with the most flagged transactions."""
    known, flagged = flagged_facts(facts.filter(F.col("customer_id").isNotNull()), scores)
    return (
        known.join(flagged.select("transaction_id"), F.col("id") == F.col("transaction_id"))
        # One row per customer and country first: a string maximum cannot be hash-aggregated.
        .groupBy("customer_id", "country")
        .agg(
            F.count("*").alias("n"),
            F.sum("quantity").alias("units"),
            F.sum(line_value()).alias("value"),
        )
        .groupBy("customer_id")
        .agg(
            F.sum("n").alias("anomaly_count"),
            exact_mean(F.sum("units"), F.sum("n"), 4, 1).alias("avg_quantity"),
            exact_mean(F.sum("value"), F.sum("n"), 6, 2).alias("avg_order_value"),
            F.max("country").alias("country"),
        )
        .orderBy(F.desc("anomaly_count"), "customer_id")
        .limit(limit)
    )


def customer_concentration(facts: DataFrame, scores: DataFrame, limit: int = 3) -> DataFrame:
    """Share of all flagged transactions held by the ``limit`` customers with most of them."""
    total = scores.agg(F.count_if("is_anomaly").alias("n")).scalar()
    held = F.coalesce(F.sum("anomaly_count"), F.lit(0))
    return (
        top_flagged_customers(facts, scores, limit)
        .agg(held.alias("top_anomalies"))
        .select(
            "top_anomalies",
            total.alias("total_anomalies"),
            percent(F.col("top_anomalies"), total).alias("pct_of_anomalies"),
        )
    )
