"""Money, averages and shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def line_value() -> Column:
    """Quantity times price. Integer times decimal stays exact."""
    return F.col("quantity") * F.col("unit_price")


def integer_mean(column: str | Column, digits: int) -> Column:
    """Mean of an integer column kept to four decimals, then rounded half up."""
    col = F.col(column) if isinstance(column, str) else column
    return F.round(F.avg(col.cast("decimal(19,0)")), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole``; NULL where the whole is zero."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def percent_half_even(part: Column, whole: Column, digits: int = 2) -> Column:
    """As ``percent``, with exact halves going to the even neighbour."""
    return F.bround(F.try_divide(part.cast("double"), whole) * 100, digits)


def exact_mean(total: Column, count: Column, kept: int, digits: int) -> Column:
    """Decimal mean from a sum and a count: ``kept`` decimals first, then rounded to ``digits``."""
    quotient = F.try_divide(total.cast("decimal(38,4)"), count.cast("decimal(20,0)"))
    return F.round(F.round(quotient, kept), digits)
