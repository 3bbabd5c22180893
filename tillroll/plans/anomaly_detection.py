"""Build the anomaly score table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators import anomalies
from tillroll.operators.isolation_forest import BAG_SIZE, SEED, TREES
from tillroll.session import new_path
from tillroll.sources.tables import MONTH, read_table, replace_table


def build_scores(
    facts: DataFrame,
    scores_path: str,
    contamination: float = anomalies.CONTAMINATION,
    trees: int = TREES,
    bag_size: int = BAG_SIZE,
    seed: int = SEED,
) -> DataFrame:
    """Score every genuine sale and flag the top share; replaces the score table and returns it.

    Raw scores are stored before the cut is looked for, so rows are scored once. Scores of facts that
    are laid out by month carry the month and are laid out alike.
    """
    spark = facts.sparkSession
    forest = anomalies.fit_sales_forest(facts, trees=trees, bag_size=bag_size, seed=seed)
    raw_path = new_path(spark, "raw-scores")
    month = [name for name in (MONTH,) if name in facts.columns]
    replace_table(anomalies.score_sales(facts, forest, month), raw_path)
    flagged = anomalies.flag_top_share(read_table(spark, raw_path), contamination=contamination)
    table = anomalies.score_table(flagged).withColumn(
        "updated_at", F.current_timestamp().cast("timestamp_ntz")
    )
    replace_table(table, scores_path, by=month)
    return read_table(spark, scores_path)
