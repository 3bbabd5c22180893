"""Render the narratives anew and save them into their history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from tillroll.operators import anomalies, narratives, segments
from tillroll.schema import NARRATIVES
from tillroll.sources import tables


def drafts(
    facts: DataFrame, segment_table: DataFrame, scores: DataFrame, only: str | None = None
) -> DataFrame:
    """Checked narratives of one type, or of all three; the executive one needs the other two."""
    if only not in (None, narratives.SEGMENT, narratives.ANOMALY):
        raise ValueError(f"no narrative of type {only!r} can be rendered by itself")
    parts = []
    if only in (None, narratives.SEGMENT):
        parts.append(narratives.segment_narratives(segments.segment_stats(segment_table)))
    if only in (None, narratives.ANOMALY):
        top = anomalies.top_flagged_customers(facts, scores)
        overview = anomalies.anomaly_overview(scores)
        # The naming rules know five segments, whose narratives come first.
        parts.append(narratives.anomaly_narrative(overview, top, seq=6))
    if only is None:
        parts.append(narratives.executive_narrative(*parts, seq=7))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def save_drafts(spark: SparkSession, drafted: DataFrame, now: Column, path: str) -> DataFrame:
    """Upsert into the stored history and return its new state. Of writers at the same time none
    loses what another one saved."""
    tables.update_versions(
        spark, path, NARRATIVES, lambda history: narratives.upsert(history, drafted, now)
    )
    return tables.read_last_version(spark, path, NARRATIVES)
