"""Grouping on text without regard to case."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_text(
    df: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column],
) -> DataFrame:
    """Sum ``sums`` by ``keys``, treating keys that differ only in case as one group.

    ``min`` over a string cannot live in a hash aggregate, so grouping the facts straight on
    ``upper(key)`` would sort them. The facts are first summed by the exact spelling (hash
    aggregate, combined before the shuffle); only one row per spelling reaches the second step,
    which folds case and shows the smallest spelling.
    """
    spelled = df.groupBy(*keys).agg(*[F.sum(expr).alias(name) for name, expr in sums.items()])
    folded = [f"__{key}" for key in keys]
    return (
        spelled.groupBy(*[F.upper(key).alias(name) for key, name in zip(keys, folded)])
        .agg(
            *[F.min(key).alias(key) for key in keys],
            *[F.sum(name).alias(name) for name in sums],
        )
        .drop(*folded)
    )


def text_order(*keys: str) -> list[Column]:
    """Sort keys that ignore case, NULL first."""
    return [F.upper(key).asc_nulls_first() for key in keys]
