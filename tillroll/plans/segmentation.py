"""Build the customer segment table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.clustering import fit_clusters
from tillroll.operators.rfm import rfm, scaled_features
from tillroll.operators.segments import label_segments, segment_table
from tillroll.session import new_path
from tillroll.sources.tables import read_table, replace_table


def _stored(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = new_path(spark, name)
    replace_table(df, path)
    return read_table(spark, path)


def build_segments(
    facts: DataFrame, segments_path: str, k: int = 3, starts: int = 10, seed: int = 42
) -> DataFrame:
    """Facts to RFM to clusters to names; replaces the segment table and returns it.

    The facts are read once: RFM is stored, and everything after works on one row per customer.
    """
    features = scaled_features(_stored(rfm(facts), "rfm"))
    clustered = _stored(fit_clusters(features, k, starts, seed), "clustered")
    table = segment_table(label_segments(clustered)).withColumns(
        {
            "monetary": F.col("monetary").cast("decimal(12,2)"),
            "updated_at": F.current_timestamp().cast("timestamp_ntz"),
        }
    )
    replace_table(table, segments_path)
    return read_table(facts.sparkSession, segments_path)
