"""Narrative texts rendered from the aggregates, their fact check and their history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.text import stats_json, unsupported_terms

SEGMENT, ANOMALY, EXECUTIVE = "segment", "anomaly", "executive"
ANOMALY_KEY = "anomaly_overview"

RECORD = (
    "seq",
    "narrative_type",
    "reference_key",
    "input_stats",
    "narrative_text",
    "flagged_terms",
)

_SEGMENT_FACTS = (
    "segment_name",
    "customer_count",
    "avg_recency_days",
    "avg_frequency",
    "avg_monetary",
)
_CUSTOMER_FACTS = ("customer_id", "anomaly_count", "avg_quantity", "avg_order_value", "country")


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("unknown"))


def with_fact_check(drafts: DataFrame, facts: list[str]) -> DataFrame:
    """Check each draft against the JSON of its ``facts`` and store both with the findings."""
    stats = F.struct(*facts)
    return (
        drafts.withColumn(
            "flagged_terms", unsupported_terms(F.col("narrative_text"), stats_json(stats))
        )
        .withColumn(
            "input_stats",
            stats_json(F.struct(*facts, F.col("flagged_terms").alias("_flagged_terms"))),
        )
        .select(*RECORD)
    )


def segment_narratives(stats: DataFrame) -> DataFrame:
    """One narrative per segment from the segment statistics, best customers first."""
    drafts = stats.withColumns(
        {
            # One row per segment name, of which the naming rules know five.
            "seq": F.row_number()
            .over(Window.orderBy(F.desc("avg_monetary"), "segment_name"))
            .cast("long"),
            "narrative_type": F.lit(SEGMENT),
            "reference_key": F.col("segment_name"),
            "narrative_text": F.format_string(
                "%s: %s customers, %s days since the last purchase on average, "
                "%s orders and $%s spent per customer.",
                *[_text(name) for name in _SEGMENT_FACTS],
            ),
        }
    )
    return with_fact_check(drafts, list(_SEGMENT_FACTS))


def anomaly_narrative(overview: DataFrame, top_customers: DataFrame, seq: int) -> DataFrame:
    """One narrative: the overview, then the top accounts in order, one line each."""
    line = F.format_string(
        "- Customer %s (%s): %s unusual transactions, %s units and $%s on average.",
        *[
            _text(name)
            for name in ("customer_id", "country", "anomaly_count", "avg_quantity")
        ],
        _text("avg_order_value"),
    )
    # At most as many rows as the top-customers report has.
    accounts = (
        top_customers.select(
            F.struct(
                (-F.col("anomaly_count")).alias("order"),
                "customer_id",
                line.alias("line"),
                F.struct(*_CUSTOMER_FACTS).alias("facts"),
            ).alias("account")
        )
        .agg(F.array_sort(F.collect_list("account")).alias("accounts"))
        .select(F.struct("accounts").alias("row"))
        .scalar()
    )
    drafts = (
        overview.select(
            F.struct("total_anomalies", "total_scored", "pct_anomalous").alias("overview"),
            accounts["accounts"].alias("accounts"),
        )
        .withColumn("top_customers", F.col("accounts")["facts"])
        .withColumns(
            {
                "seq": F.lit(seq).cast("long"),
                "narrative_type": F.lit(ANOMALY),
                "reference_key": F.lit(ANOMALY_KEY),
                "narrative_text": F.concat(
                    F.format_string(
                        "Of %s transactions scored, %s are unusual (%s%%). "
                        "Unusual does not mean wrong or fraudulent.\n",
                        F.col("overview.total_scored").cast("string"),
                        F.col("overview.total_anomalies").cast("string"),
                        F.coalesce(F.col("overview.pct_anomalous").cast("string"), F.lit("0.0")),
                    ),
                    F.array_join(F.col("accounts")["line"], "\n"),
                ),
            }
        )
    )
    return with_fact_check(drafts, ["overview", "top_customers"])


def executive_narrative(segments: DataFrame, anomaly: DataFrame, seq: int) -> DataFrame:
    """One narrative that puts the segment texts and the anomaly text together, in their order."""
    parts = (
        segments.agg(
            F.array_sort(
                F.collect_list(F.struct("seq", "reference_key", "narrative_text"))
            ).alias("parts")
        )
        .select(F.struct("parts").alias("row"))
        .scalar()
    )
    drafts = (
        anomaly.select(
            F.col("narrative_text").alias("anomaly_narrative"), parts["parts"].alias("parts")
        )
        .withColumns(
            {
                "segment_narratives": F.map_from_arrays(
                    F.col("parts")["reference_key"], F.col("parts")["narrative_text"]
                ),
                "seq": F.lit(seq).cast("long"),
                "narrative_type": F.lit(EXECUTIVE),
                "reference_key": F.lit(None).cast("string"),
                "narrative_text": F.concat(
                    F.array_join(F.col("parts")["narrative_text"], "\n\n"),
                    F.lit("\n\nAnomalies: "),
                    F.col("anomaly_narrative"),
                ),
            }
        )
    )
    return with_fact_check(drafts, ["segment_narratives", "anomaly_narrative"])


def only_type(narratives: DataFrame, narrative_type: str | None) -> DataFrame:
    """Narratives of one type, to regenerate these alone; all of them for None."""
    if narrative_type is None:
        return narratives
    return narratives.filter(F.upper("narrative_type") == narrative_type.upper())


def _group() -> list[Column]:
    return [F.upper("narrative_type").alias("__type"), F.upper("reference_key").alias("__key")]


def latest_narratives(history: DataFrame) -> DataFrame:
    """Rows as recent as the most recent of their (type, key); rows tied for it all stay.

    Maximum per key, then a join back, rather than a window: the maximum combines before the
    shuffle, and a key with very many rows is split over tasks by the join.
    """
    latest = history.groupBy(*_group()).agg(F.max("generated_at").alias("latest"))
    rows = history.select("*", *_group()).alias("n")
    newest = latest.alias("m")
    return rows.join(
        newest,
        (F.col("n.__type") == F.col("m.__type"))
        & F.col("n.__key").eqNullSafe(F.col("m.__key"))
        & (F.col("n.generated_at") == F.col("m.latest")),
        "left_semi",
    ).select("narrative_type", "reference_key", "narrative_text", "generated_at")


def newest_by_id(history: DataFrame) -> DataFrame:
    """One row per (type, key), the one with the highest id; NULL keys are one key."""
    columns = history.columns
    return (
        history.groupBy(*_group())
        .agg(F.max_by(F.struct(*columns), "id").alias("row"))
        .select(*[F.col("row")[name].alias(name) for name in columns])
    )


def upsert(history: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """``history`` (unique by type and key) after saving ``incoming`` in order of ``seq``.

    A known (type, key) keeps its id and spelling and takes the new statistics, text and time; an
    unknown one is added with the id a counter would give it, one step per save. Saving a key
    twice leaves the later content. The result is a new table: write it to a new path.
    """
    last_id = history.agg(F.coalesce(F.max("id"), F.lit(0)).alias("id")).scalar()
    payload = ("narrative_type", "reference_key", "input_stats", "narrative_text")
    saved = (
        incoming.groupBy(*_group())
        .agg(F.min("seq").alias("seq"), F.max_by(F.struct(*payload), "seq").alias("row"))
        .alias("new")
    )
    known = history.select(*_group(), "*").alias("old")
    joined = known.join(
        saved,
        (F.col("old.__type") == F.col("new.__type"))
        & F.col("old.__key").eqNullSafe(F.col("new.__key")),
        "full_outer",
    )
    is_known, is_saved = F.col("old.id").isNotNull(), F.col("new.seq").isNotNull()

    def kept(name: str) -> Column:
        return F.when(is_known, F.col(f"old.{name}")).otherwise(F.col(f"new.row.{name}"))

    def refreshed(name: str) -> Column:
        return F.when(is_saved, F.col(f"new.row.{name}")).otherwise(F.col(f"old.{name}"))

    return joined.select(
        F.coalesce(F.col("old.id"), last_id + F.col("new.seq")).alias("id"),
        kept("narrative_type").alias("narrative_type"),
        kept("reference_key").alias("reference_key"),
        refreshed("input_stats").alias("input_stats"),
        refreshed("narrative_text").alias("narrative_text"),
        F.when(is_saved, now).otherwise(F.col("old.generated_at")).alias("generated_at"),
    )
