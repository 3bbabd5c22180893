"""One Spark query per operator, each over whole tables.

Outputs are cast to plain types, and floats rounded, so that another engine's answer compares equal.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import flags, measures, text
from tillroll.operators import (
    anomalies,
    clustering,
    lloyd,
    narratives,
    quality,
    reports,
    rfm,
    segments,
    views,
)
from tillroll.plans import load
from tillroll.session import new_path
from tillroll.sources import raw_invoices, tables, testtables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The range used wherever a query takes dates.
WINDOW_FIRST, WINDOW_LAST = "1995-03-15", "1997-10-20"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _cast(df: DataFrame, **types: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    # + 0.0 turns a negative zero into zero
    return df.withColumns({name: F.round(F.col(name), digits) + F.lit(0.0) for name in names})


MONEY = "decimal(38,2)"


# Sources and sinks ---------------------------------------------------------------------------


def raw_invoices_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts as a careless export would write them: all text, some of it unusable."""
    row = F.abs("id")
    moment = F.col("invoice_date")
    slashed = F.format_string(
        "%d/%d/%d %d:%02d", *[part(moment) for part in (F.month, F.day, F.year, F.hour, F.minute)]
    )
    quantity = F.col("quantity").cast("string")
    return testtables.facts(spark, sf_dir).select(
        F.when(row % 1009 != 5, F.col("invoice_no")).alias("Invoice"),
        F.col("stock_code").alias("StockCode"),
        F.when(row % 401 == 7, F.lit("nan")).otherwise(F.col("description")).alias("Description"),
        F.when(row % 211 == 3, F.lit("n/a"))
        .when(row % 223 == 5, F.concat(quantity, F.lit(".0")))
        .otherwise(quantity)
        .alias("Quantity"),
        F.when(row % 307 == 2, F.lit("not a date"))
        .when(row % 311 == 4, slashed)
        .otherwise(moment.cast("string"))
        .alias("InvoiceDate"),
        F.when(row % 419 == 6, F.lit("free"))
        .otherwise(F.col("unit_price").cast("string"))
        .alias("Price"),
        F.concat(F.col("customer_id").cast("string"), F.lit(".0")).alias("Customer ID"),
        F.when(row % 17 == 1, F.lit("CÔTE D'IVOIRE")).otherwise(F.col("country")).alias("Country"),
    )


def _raw_file(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "raw-invoices")
    (
        raw_invoices_of(spark, sf_dir)
        .write.options(header=True, escape='"', encoding=raw_invoices.SOURCE_ENCODING)
        .csv(path)
    )
    return path


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_invoices.read_raw_csv(spark, _raw_file(spark, sf_dir))
    return raw_invoices.coerce_types(raw)


@query
def s1_read_raw_csv(spark, sf_dir):
    return raw_invoices.read_raw_csv(spark, _raw_file(spark, sf_dir))


@query
def s2_select_source_columns(spark, sf_dir):
    raw = raw_invoices_of(spark, sf_dir)
    shuffled = raw.select(F.lit(1).alias("Extra"), *reversed(raw.columns))
    return raw_invoices.select_source_columns(shuffled)


@query
def s3_coerce_types(spark, sf_dir):
    return _typed(spark, sf_dir)


@query
def s4_drop_unusable(spark, sf_dir):
    return raw_invoices.drop_unusable(_typed(spark, sf_dir))


@query
def s4_load_report(spark, sf_dir):
    return raw_invoices.load_report(_typed(spark, sf_dir))


@query
def s4_load_reasons(spark, sf_dir):
    """The report of a whole load."""
    return load.load_invoices(spark, _raw_file(spark, sf_dir), new_path(spark, "loaded"))


@query
def s6_append_once(spark, sf_dir):
    """The same file twice into a table with a ledger: the second load adds nothing."""
    raw, path = _raw_file(spark, sf_dir), new_path(spark, "loaded-once")
    load.load_invoices(spark, raw, path, once=True)
    load.load_invoices(spark, raw, path, once=True)
    columns = [name for name in raw_invoices.ID_ORDER]
    return tables.read_table(spark, path).select("id", *columns)


@query
def s5_row_ids(spark, sf_dir):
    path = new_path(spark, "usable")
    raw_invoices.drop_unusable(_typed(spark, sf_dir)).write.parquet(path)
    return raw_invoices.with_row_id(tables.read_table(spark, path), after=1000)


@query
def s6_append_twice(spark, sf_dir):
    path = new_path(spark, "appended")
    load = raw_invoices.drop_unusable(_typed(spark, sf_dir))
    tables.append_facts(load, path)
    tables.append_facts(load, path)
    return (
        tables.read_table(spark, path)
        .groupBy("invoice_month")
        .agg(F.count("*").alias("row_count"), F.sum("quantity").alias("units"))
    )


@query
def s7_replace_twice(spark, sf_dir):
    path = new_path(spark, "replaced")
    rows = testtables.segments(spark, sf_dir)
    tables.replace_table(rows, path)
    tables.replace_table(rows, path)
    return tables.read_table(spark, path)


@query
def s8_projected_scan(spark, sf_dir):
    return (
        testtables.facts(spark, sf_dir)
        .filter(flags.genuine_sale())
        .select("id", "customer_id", "quantity", "unit_price")
    )


@query
def s9_export_csv(spark, sf_dir):
    path = new_path(spark, "daily-revenue-csv")
    report = _cast(reports.daily_revenue(testtables.facts(spark, sf_dir)), revenue=MONEY)
    tables.export_csv(report, path, files=1)
    return spark.read.option("header", True).csv(path)


@query
def s10_stats_json(spark, sf_dir):
    history = testtables.narrative_history(spark, sf_dir)
    stats = F.struct(
        "narrative_type",
        "reference_key",
        F.struct("id", F.col("narrative_text").alias("text")).alias("source"),
    )
    return history.select("id", text.stats_json(stats).alias("input_stats"))


# Flags ---------------------------------------------------------------------------------------


def _flag(name: str) -> None:
    def one_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
        return testtables.facts(spark, sf_dir).select("id", name)

    position = flags.FLAG_COLUMNS.index(name) + 1
    QUERIES[f"f{position}_{name}"] = one_flag


for _name in flags.FLAG_COLUMNS:
    _flag(_name)


@query
def f7_reference_key_norm(spark, sf_dir):
    history = testtables.narrative_history(spark, sf_dir)
    return history.select("id", flags.reference_key_norm().alias("reference_key_norm"))


@query
def f8_line_value(spark, sf_dir):
    rows = testtables.facts(spark, sf_dir)
    return rows.select("id", measures.line_value().cast(MONEY).alias("total_value"))


@query
def f9_genuine_sales(spark, sf_dir):
    return testtables.facts(spark, sf_dir).select("id", flags.genuine_sale().alias("is_genuine"))


# Views ---------------------------------------------------------------------------------------


@query
def v1_revenue_transactions(spark, sf_dir):
    rows = views.revenue_transactions(testtables.facts(spark, sf_dir))
    return rows.drop(tables.MONTH)


@query
def v2_customer_transactions(spark, sf_dir):
    rows = views.customer_transactions(testtables.facts(spark, sf_dir))
    return rows.drop(tables.MONTH)


@query
def v3_net_sales(spark, sf_dir):
    return _cast(views.net_sales(testtables.facts(spark, sf_dir)), net_revenue=MONEY)


@query
def v4_anomaly_detail(spark, sf_dir):
    rows = views.anomaly_detail(testtables.facts(spark, sf_dir), testtables.scores(spark, sf_dir))
    return _cast(rows, total_value=MONEY)


# Audits --------------------------------------------------------------------------------------


@query
def q1_cleaning_summary(spark, sf_dir):
    return quality.cleaning_summary(testtables.facts(spark, sf_dir))


@query
def q2_exact_duplicates(spark, sf_dir):
    return quality.exact_duplicates(testtables.facts(spark, sf_dir))


@query
def q3_date_range(spark, sf_dir):
    return quality.date_range(testtables.facts(spark, sf_dir))


@query
def q4_outside_window(spark, sf_dir):
    rows = testtables.facts(spark, sf_dir)
    return quality.outside_window(rows, WINDOW_FIRST, WINDOW_LAST).drop(tables.MONTH)


@query
def q5_cancellation_by_sign(spark, sf_dir):
    return quality.cancellation_by_sign(testtables.facts(spark, sf_dir))


@query
def q6_stock_adjustment_rows(spark, sf_dir):
    return quality.stock_adjustment_rows(testtables.facts(spark, sf_dir))


@query
def q7_stock_adjustment_tally(spark, sf_dir):
    return quality.stock_adjustment_tally(testtables.facts(spark, sf_dir))


@query
def q8_cancelled_not_negative(spark, sf_dir):
    return quality.cancelled_not_negative(testtables.facts(spark, sf_dir)).drop(tables.MONTH)


@query
def q9_constraint_audit(spark, sf_dir):
    return quality.constraint_audit(
        testtables.facts(spark, sf_dir),
        testtables.segments(spark, sf_dir),
        testtables.scores(spark, sf_dir),
        testtables.narrative_history(spark, sf_dir),
    )


# Customers -----------------------------------------------------------------------------------


@query
def r1_rfm(spark, sf_dir):
    return _cast(rfm.rfm(testtables.facts(spark, sf_dir)), monetary=MONEY)


@query
def r2_log_features(spark, sf_dir):
    logged = rfm.log_features(testtables.segments(spark, sf_dir))
    return _rounded(
        logged.select("customer_id", "log_frequency", "log_monetary"),
        "log_frequency",
        "log_monetary",
    )


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.scaled_features(testtables.segments(spark, sf_dir))


@query
def r3_scaled_features(spark, sf_dir):
    return _rounded(_features(spark, sf_dir).select("customer_id", *rfm.SCALED), *rfm.SCALED)


@query
def r4_k_sweep(spark, sf_dir):
    return clustering.k_sweep(_features(spark, sf_dir).drop("cluster", "segment_name"))


@query
def r4_lloyd_step(spark, sf_dir):
    """One joint iteration for three numbers of clusters; first centres are the first customers."""
    features = _features(spark, sf_dir)
    first = features.orderBy("customer_id").select(*rfm.SCALED).limit(5).collect()
    centres = [np.array([tuple(row) for row in first[:k]]) for k in (2, 3, 5)]
    cells = lloyd.cells_of(features, rfm.SCALED)
    rows = [
        (len(after), place, n, *[float(x) for x in centre])
        for after, sizes in lloyd.lloyd_step(cells, centres)
        for place, (centre, n) in enumerate(zip(after, sizes, strict=True))
    ]
    names = ", ".join(f"{name} double" for name in rfm.SCALED)
    moved = spark.createDataFrame(rows, f"k int, cluster int, customers long, {names}")
    return _rounded(moved, *rfm.SCALED)


@query
def r5_euclidean_silhouette(spark, sf_dir):
    return _rounded(clustering.euclidean_silhouette(_features(spark, sf_dir)), "silhouette")


@query
def r5_squared_silhouette(spark, sf_dir):
    rows = _features(spark, sf_dir)
    value = clustering.squared_silhouette(clustering.feature_vectors(rows))
    return rows.agg(
        F.count("*").alias("customers"), F.lit(round(value, 6)).alias("silhouette_squared")
    )


@query
def r6_kmeans_segments(spark, sf_dir):
    features = _features(spark, sf_dir).drop("cluster", "segment_name")
    fitted = clustering.fit_clusters(features, k=3)
    return segments.segment_table(segments.label_segments(fitted))


@query
def r6b_assign_to_centroids(spark, sf_dir):
    rows = _features(spark, sf_dir)
    centroids = clustering.centroids_of(rows)
    assigned = clustering.assign_to_centroids(rows.drop("cluster"), centroids)
    return assigned.select("customer_id", "cluster")


@query
def r7_overall_medians(spark, sf_dir):
    medians = segments.overall_medians(testtables.clustered(spark, sf_dir))
    return _rounded(medians, *segments.MEASURES, digits=4)


@query
def r8_cluster_means(spark, sf_dir):
    means = segments.cluster_means(testtables.clustered(spark, sf_dir))
    return _rounded(means, *segments.MEASURES, digits=4)


@query
def r9_label_segments(spark, sf_dir):
    return segments.label_segments(testtables.clustered(spark, sf_dir)).select(
        "customer_id", "cluster", "segment_name"
    )


@query
def r10_segment_profile(spark, sf_dir):
    profile = segments.segment_profile(testtables.segments(spark, sf_dir))
    return _rounded(profile, *[f"{name}_mean" for name in segments.MEASURES], digits=4)


@query
def r11_segment_stats(spark, sf_dir):
    stats = segments.segment_stats(testtables.segments(spark, sf_dir))
    return _cast(
        stats,
        avg_recency_days="decimal(18,1)",
        avg_frequency="decimal(18,1)",
        avg_monetary="decimal(18,2)",
    )


@query
def r12_segment_shares(spark, sf_dir):
    return segments.segment_shares(testtables.segments(spark, sf_dir))


@query
def r13_segment_table(spark, sf_dir):
    return segments.segment_table(testtables.segments(spark, sf_dir))


# Anomalies -----------------------------------------------------------------------------------


@query
def a1_sale_features(spark, sf_dir):
    return _cast(anomalies.sale_features(testtables.facts(spark, sf_dir)), total_value=MONEY)


@query
def a2_log_features(spark, sf_dir):
    logged = anomalies.log_features(anomalies.sale_features(testtables.facts(spark, sf_dir)))
    names = ("log_quantity", "log_unit_price", "log_total_value")
    return _rounded(logged.select("id", *names), *names)


@query
def a3_isolation_forest(spark, sf_dir):
    return anomalies.fit_sales_forest(testtables.facts(spark, sf_dir))


@query
def a4_anomaly_scores(spark, sf_dir):
    rows = testtables.facts(spark, sf_dir)
    return anomalies.score_sales(rows, anomalies.fit_sales_forest(rows))


def _scored_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line value in millions, as a score that SQL can state."""
    sales = anomalies.sale_features(testtables.facts(spark, sf_dir))
    return sales.select("id", (F.col("total_value").cast("double") / 1000000).alias("raw_score"))


@query
def a5_flag_top_share(spark, sf_dir):
    flagged = anomalies.flag_top_share(_scored_by_rule(spark, sf_dir))
    return _rounded(flagged.select("id", "anomaly_score", "is_anomaly"), "anomaly_score")


@query
def a6_top_anomalies(spark, sf_dir):
    rows = anomalies.top_anomalies(
        testtables.facts(spark, sf_dir), testtables.scores(spark, sf_dir)
    )
    return _cast(rows, total_value=MONEY)


@query
def a7_score_table(spark, sf_dir):
    return anomalies.score_table(anomalies.flag_top_share(_scored_by_rule(spark, sf_dir)))


@query
def a8_flagged_detail(spark, sf_dir):
    rows = anomalies.flagged_detail(
        testtables.facts(spark, sf_dir), testtables.scores(spark, sf_dir)
    )
    return _cast(rows, total_value=MONEY)


@query
def a9_anomaly_overview(spark, sf_dir):
    return anomalies.anomaly_overview(testtables.scores(spark, sf_dir))


def _top_customers(spark: SparkSession, sf_dir: str, limit: int) -> DataFrame:
    rows = anomalies.top_flagged_customers(
        testtables.facts(spark, sf_dir), testtables.scores(spark, sf_dir), limit
    )
    return _cast(rows, avg_quantity="decimal(18,1)", avg_order_value="decimal(18,2)")


@query
def a10_top_flagged_customers(spark, sf_dir):
    return _top_customers(spark, sf_dir, 10)


@query
def a11_customer_concentration(spark, sf_dir):
    return anomalies.customer_concentration(
        testtables.facts(spark, sf_dir), testtables.scores(spark, sf_dir)
    )


# Reports -------------------------------------------------------------------------------------


@query
def d1_daily_revenue(spark, sf_dir):
    return _cast(reports.daily_revenue(testtables.facts(spark, sf_dir)), revenue=MONEY)


@query
def d2_top_products(spark, sf_dir):
    return _cast(reports.top_products(testtables.facts(spark, sf_dir)), revenue=MONEY)


@query
def d3_monthly_revenue(spark, sf_dir):
    return _cast(reports.monthly_revenue(testtables.facts(spark, sf_dir)), revenue=MONEY)


@query
def d4_headline_figures(spark, sf_dir):
    figures = reports.headline_figures(
        testtables.facts(spark, sf_dir), testtables.scores(spark, sf_dir)
    )
    return _cast(figures, total_revenue=MONEY, products_tracked="bigint")


def _slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sliced(testtables.facts(spark, sf_dir), WINDOW_FIRST, WINDOW_LAST)


@query
def d5_sliced_daily_revenue(spark, sf_dir):
    return _cast(reports.daily_revenue(_slice(spark, sf_dir)), revenue=MONEY)


@query
def d5_sliced_top_products(spark, sf_dir):
    return _cast(reports.top_products(_slice(spark, sf_dir), 10), revenue=MONEY)


@query
def d5_sliced_monthly_revenue(spark, sf_dir):
    return _cast(reports.monthly_revenue(_slice(spark, sf_dir)), revenue=MONEY)


@query
def d5_sliced_headline_figures(spark, sf_dir):
    figures = reports.headline_figures(_slice(spark, sf_dir), testtables.scores(spark, sf_dir))
    return _cast(figures, total_revenue=MONEY, products_tracked="bigint")


@query
def d6_latest_narratives(spark, sf_dir):
    return narratives.latest_narratives(testtables.narrative_history(spark, sf_dir))


# Narratives ----------------------------------------------------------------------------------


def _segment_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return narratives.segment_narratives(r11_segment_stats(spark, sf_dir))


def _anomaly_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    overview = a9_anomaly_overview(spark, sf_dir)
    return narratives.anomaly_narrative(overview, _top_customers(spark, sf_dir, 3), seq=6)


def _executive_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return narratives.executive_narrative(
        _segment_texts(spark, sf_dir), _anomaly_text(spark, sf_dir), seq=7
    )


_TEXT_FIELDS = ("seq", "narrative_type", "reference_key", "narrative_text")


@query
def n1_segment_narratives(spark, sf_dir):
    return _segment_texts(spark, sf_dir).select(*_TEXT_FIELDS)


@query
def n2_anomaly_narrative(spark, sf_dir):
    return _anomaly_text(spark, sf_dir).select(*_TEXT_FIELDS)


@query
def n3_executive_narrative(spark, sf_dir):
    return _executive_text(spark, sf_dir).select(*_TEXT_FIELDS)


def _terms(terms: Column) -> list[Column]:
    return [
        F.size(terms).cast("bigint").alias("flagged_count"),
        F.array_join(terms, " ").alias("flagged_terms"),
    ]


@query
def n4_fact_check_documents(spark, sf_dir):
    stats = text.stats_json(F.struct("lang", "source", "n_chars"))
    terms = text.unsupported_terms(F.col("text"), stats)
    documents = testtables.table(spark, sf_dir, "documents")
    checked = documents.select("doc_id", terms.alias("terms"))
    return checked.select("doc_id", *_terms(F.col("terms")))


@query
def n4_fact_check_replies(spark, sf_dir):
    """Every turn against the whole turn before it."""
    turns = testtables.table(spark, sf_dir, "conversations")
    before = turns.select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("prompt")
    )
    stats = text.stats_json(F.struct("role", "prompt"))
    terms = text.unsupported_terms(F.col("text"), stats)
    return (
        turns.join(before, ["conv_id", "turn"], "left")
        .select("conv_id", "turn", terms.alias("terms"))
        .select("conv_id", "turn", *_terms(F.col("terms")))
    )


@query
def n5_stored_findings(spark, sf_dir):
    records = (
        _segment_texts(spark, sf_dir)
        .unionByName(_anomaly_text(spark, sf_dir))
        .unionByName(_executive_text(spark, sf_dir))
    )
    stored = F.from_json("input_stats", "_flagged_terms array<string>")["_flagged_terms"]
    return records.select("seq", "narrative_type", *_terms(stored))


@query
def n6_newest_by_id(spark, sf_dir):
    return narratives.newest_by_id(testtables.narrative_history(spark, sf_dir))


def incoming_narratives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narratives to save: partly for known keys, partly for new ones, some keys twice."""
    conversation = F.col("conv_id")
    return testtables.table(spark, sf_dir, "conversations").select(
        (conversation * 100 + F.col("turn")).alias("seq"),
        F.col("role").alias("narrative_type"),
        F.when(
            conversation % 11 != 0, F.concat(F.lit("k"), (conversation % 60).cast("string"))
        ).alias("reference_key"),
        testtables.stats_of_turn().alias("input_stats"),
        F.concat(F.lit("new: "), F.col("text")).alias("narrative_text"),
    )


_NOW = "2024-06-01 12:00:00"


@query
def n7_upsert(spark, sf_dir):
    history = narratives.newest_by_id(testtables.narrative_history(spark, sf_dir))
    saved = narratives.upsert(
        history, incoming_narratives(spark, sf_dir), F.lit(_NOW).cast("timestamp_ntz")
    )
    path = new_path(spark, "narratives")
    tables.replace_table(saved, path)
    return tables.read_table(spark, path)


@query
def n8_regenerate_one_type(spark, sf_dir):
    history = narratives.newest_by_id(testtables.narrative_history(spark, sf_dir))
    incoming = narratives.only_type(incoming_narratives(spark, sf_dir), "assistant")
    return narratives.upsert(history, incoming, F.lit(_NOW).cast("timestamp_ntz"))
