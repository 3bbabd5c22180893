"""Write the report tables as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.operators import anomalies, narratives, quality, reports, segments
from tillroll.sources.tables import export_csv


def export_reports(
    facts: DataFrame,
    segment_table: DataFrame,
    scores: DataFrame,
    history: DataFrame,
    folder: str,
) -> None:
    """One folder per report. Reports of bounded size are one file; tables that grow with the
    customers or the facts keep their partitions."""
    bounded = {
        "cleaning_summary": quality.cleaning_summary(facts),
        "overview_daily_revenue": reports.daily_revenue(facts),
        "top_products": reports.top_products(facts),
        "segment_profile": segments.segment_profile(segment_table),
        "transaction_anomalies_top50": anomalies.top_anomalies(facts, scores),
    }
    growing = {
        "customer_segments": segments.segment_table(segment_table),
        "anomaly_detail": anomalies.flagged_detail(facts, scores),
        "narratives": narratives.latest_narratives(history),
    }
    for name, report in bounded.items():
        export_csv(report, f"{folder}/{name}", files=1)
    for name, table in growing.items():
        export_csv(table, f"{folder}/{name}")
