"""Data-quality audit queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.flags import ensure_flags
from tillroll.functions.grouping import group_text, text_order
from tillroll.functions.measures import percent_half_even
from tillroll.schema import BUSINESS_COLUMNS, REQUIRED_COLUMNS
from tillroll.sources.tables import outside

_TEXT_COLUMNS = ("invoice_no", "stock_code", "description", "country")


def cleaning_summary(facts: DataFrame) -> DataFrame:
    """(metric, count, pct_of_total): one pass over the facts, then one row turned on its side."""
    counts = ensure_flags(facts).agg(
        F.count("*").alias("total_rows"),
        F.count_if("is_missing_customer").alias("missing_customer_id"),
        F.count_if("is_return").alias("negative_quantity"),
        F.count_if("is_invalid_price").alias("zero_or_negative_price"),
        F.count_if("is_non_product").alias("non_product_stock_codes"),
        F.count_if("is_cancellation").alias("cancellation_invoices"),
        F.count_if("is_stock_adjustment").alias("stock_adjustments"),
    )
    metrics = counts.columns
    return (
        counts.withColumn("__total", F.col("total_rows"))
        .unpivot("__total", metrics, "metric", "count")
        .select(
            "metric",
            "count",
            F.when(F.col("metric") == "total_rows", F.lit(100.0))
            .otherwise(percent_half_even(F.col("count"), F.col("__total")))
            .alias("pct_of_total"),
        )
    )


def exact_duplicates(facts: DataFrame) -> DataFrame:
    """Groups of rows alike in all eight business columns, with how often each occurs.

    Most rows have no twin, so grouping on the columns themselves would ship the whole table.
    An 8-byte fingerprint is grouped first; only rows whose fingerprint occurs twice are then
    grouped on the columns, which also sorts out fingerprints that collide by chance.
    """
    folded = [F.upper(name) if name in _TEXT_COLUMNS else F.col(name) for name in BUSINESS_COLUMNS]
    # NULL and empty text hash alike, so whether a column is there goes into the fingerprint.
    fingerprint = F.xxhash64(*folded, *[F.col(name).isNull() for name in BUSINESS_COLUMNS])
    repeated = (
        facts.select(fingerprint.alias("__print"))
        .groupBy("__print")
        .count()
        .filter("count > 1")
        .select("__print")
    )
    candidates = facts.select(fingerprint.alias("__print"), *BUSINESS_COLUMNS).join(
        repeated, "__print", "left_semi"
    )
    spelled = candidates.groupBy(*BUSINESS_COLUMNS).agg(F.count("*").alias("occurrences"))
    keys = {
        name: f"__{name}" if name in _TEXT_COLUMNS else name for name in BUSINESS_COLUMNS
    }
    return (
        spelled.groupBy(*[expr.alias(keys[name]) for name, expr in zip(BUSINESS_COLUMNS, folded)])
        .agg(
            *[F.min(name).alias(name) for name in _TEXT_COLUMNS],
            F.sum("occurrences").alias("occurrences"),
        )
        .filter("occurrences > 1")
        .select(*BUSINESS_COLUMNS, "occurrences")
        .orderBy(F.desc("occurrences"), *BUSINESS_COLUMNS)
    )


def date_range(facts: DataFrame) -> DataFrame:
    """Earliest and latest invoice, and the number of rows."""
    return facts.agg(
        F.min("invoice_date").alias("earliest"),
        F.max("invoice_date").alias("latest"),
        F.count("*").alias("total_rows"),
    )


def outside_window(
    facts: DataFrame, start: str | date, end: str | date, limit: int = 50
) -> DataFrame:
    """The first ``limit`` rows dated outside the expected window."""
    return outside(facts, start, end).orderBy("id").limit(limit)


def cancellation_by_sign(facts: DataFrame) -> DataFrame:
    """Do cancelled invoices and negative quantities coincide?"""
    return (
        ensure_flags(facts)
        .groupBy("is_cancellation", F.col("is_return").alias("is_negative_qty"))
        .agg(F.count("*").alias("row_count"))
    )


def stock_adjustment_rows(facts: DataFrame, limit: int = 30) -> DataFrame:
    """The most negative quantities on invoices that are not cancellations."""
    return (
        ensure_flags(facts)
        .filter(~F.col("is_cancellation") & F.col("is_return"))
        .orderBy("quantity", "id")
        .limit(limit)
        .select(
            "stock_code",
            "description",
            "quantity",
            "unit_price",
            "invoice_no",
            "customer_id",
            "country",
        )
    )


def stock_adjustment_tally(facts: DataFrame, limit: int = 20) -> DataFrame:
    """Products that dominate the stock adjustments."""
    adjustments = ensure_flags(facts).filter(~F.col("is_cancellation") & F.col("is_return"))
    keys = ["stock_code", "description"]
    return (
        group_text(adjustments, keys, {"occurrences": F.lit(1), "total_qty": F.col("quantity")})
        .orderBy(F.desc("occurrences"), *text_order(*keys))
        .limit(limit)
    )


def cancelled_not_negative(facts: DataFrame) -> DataFrame:
    """Cancelled invoices whose quantity is not negative."""
    return ensure_flags(facts).filter(F.col("is_cancellation") & ~F.col("is_return"))


def constraint_audit(
    facts: DataFrame, segments: DataFrame, scores: DataFrame, narratives: DataFrame
) -> DataFrame:
    """(rule, violations) for the rules a database would enforce on the four tables."""
    missing = facts.agg(
        *[F.count_if(F.col(name).isNull()).alias(f"{name} not null") for name in REQUIRED_COLUMNS]
    )
    # Both keys and the reference between them come out of one shuffle on the id.
    ids = (
        facts.select(F.col("id"), F.lit(1).alias("fact"), F.lit(0).alias("score"))
        .unionByName(
            scores.select(
                F.col("transaction_id").alias("id"), F.lit(0).alias("fact"), F.lit(1).alias("score")
            )
        )
        .groupBy("id")
        .agg(F.sum("fact").alias("facts"), F.sum("score").alias("scores"))
        .agg(
            F.count_if(F.col("facts") > 1).alias("transactions id unique"),
            F.count_if(F.col("scores") > 1).alias("transaction_anomalies transaction_id unique"),
            F.coalesce(F.sum(F.when(F.col("facts") == 0, F.col("scores"))), F.lit(0)).alias(
                "transaction_anomalies transaction_id references transactions"
            ),
        )
    )
    customers = (
        segments.groupBy("customer_id")
        .count()
        .agg(F.count_if(F.col("count") > 1).alias("customer_segments customer_id unique"))
    )
    keys = (
        narratives.groupBy(F.upper("narrative_type"), F.upper("reference_key"))
        .count()
        .agg(F.count_if(F.col("count") > 1).alias("narratives (type, key) unique"))
    )
    rules = [
        table.unpivot([], table.columns, "rule", "violations")
        for table in (missing, ids, customers, keys)
    ]
    out = rules[0]
    for table in rules[1:]:
        out = out.unionByName(table)
    return out
