"""Views over the flagged facts: each is a lens, none removes anything from the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.flags import ensure_flags
from tillroll.functions.grouping import group_text
from tillroll.functions.measures import line_value


def revenue_transactions(facts: DataFrame) -> DataFrame:
    """Products at a valid price, without warehouse corrections. Cancellations stay."""
    return ensure_flags(facts).filter(
        ~F.col("is_non_product") & ~F.col("is_invalid_price") & ~F.col("is_stock_adjustment")
    )


def customer_transactions(facts: DataFrame) -> DataFrame:
    """Revenue rows of known customers."""
    return revenue_transactions(facts).filter(~F.col("is_missing_customer"))


def net_sales(facts: DataFrame) -> DataFrame:
    """Units and revenue by product, returns netted against purchases."""
    return group_text(
        revenue_transactions(facts),
        ["stock_code", "description"],
        {"net_quantity": F.col("quantity"), "net_revenue": line_value()},
    )


def anomaly_detail(facts: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores joined to the transactions they belong to."""
    return (
        scores.join(facts, scores["transaction_id"] == facts["id"])
        .withColumn("total_value", line_value())
        .select(
            "transaction_id",
            "invoice_no",
            "customer_id",
            "country",
            "quantity",
            "unit_price",
            "total_value",
            "invoice_date",
            "anomaly_score",
            "is_anomaly",
        )
    )
