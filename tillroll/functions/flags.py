"""Data-quality flags and the predicates built from them.

Rows are never removed for being odd: each one carries its flags and the views choose. Text is
compared without regard to case, so every comparison goes through ``upper``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.schema import CANCELLATION_PREFIX, FLAG_COLUMNS, NO_REFERENCE_KEY, NON_PRODUCT_CODES


def is_cancellation() -> Column:
    return F.upper("invoice_no").startswith(CANCELLATION_PREFIX)


def is_missing_customer() -> Column:
    return F.col("customer_id").isNull()


def is_return() -> Column:
    return F.col("quantity") < 0


def is_invalid_price() -> Column:
    return F.col("unit_price") <= 0


def is_non_product(codes: Iterable[str] = NON_PRODUCT_CODES) -> Column:
    return F.upper("stock_code").isin([code.upper() for code in codes])


def is_stock_adjustment() -> Column:
    return is_return() & ~is_cancellation()


def with_flags(df: DataFrame, non_product_codes: Iterable[str] = NON_PRODUCT_CODES) -> DataFrame:
    """Add the six flags. Recomputes any already there, so they cannot drift from their columns."""
    return df.withColumns(
        {
            "is_cancellation": is_cancellation(),
            "is_missing_customer": is_missing_customer(),
            "is_return": is_return(),
            "is_invalid_price": is_invalid_price(),
            "is_non_product": is_non_product(non_product_codes),
            "is_stock_adjustment": is_stock_adjustment(),
        }
    )


def ensure_flags(df: DataFrame) -> DataFrame:
    """Flags as stored where the table has them (they push down to the scan), else computed."""
    return df if set(FLAG_COLUMNS) <= set(df.columns) else with_flags(df)


def genuine_sale() -> Column:
    """A known customer buying something at a price. Needs the flag columns."""
    return (
        F.col("customer_id").isNotNull()
        & ~F.col("is_cancellation")
        & ~F.col("is_stock_adjustment")
        & (F.col("quantity") > 0)
        & (F.col("unit_price") > 0)
    )


def reference_key_norm(key: str = "reference_key") -> Column:
    """Key with NULL replaced by the sentinel. A real key equal to the sentinel would collide, so
    the operators compare with ``eqNullSafe`` and keep this for output only."""
    return F.coalesce(F.col(key), F.lit(NO_REFERENCE_KEY))
