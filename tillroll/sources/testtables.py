"""Retail tables derived from the given test tables.

The given tables are clean, so every kind of defect is planted by arithmetic on keys; the rules are
those of FIXTURES.md. ``transactions`` is the bare derivation. ``facts``, ``segments`` and
``scores`` are stored once per application in the shared folder, as a warehouse would keep them,
so that queries read only the columns and months they need.
"""

from __future__ import annotations

from collections.abc import Sequence
from threading import Lock

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.functions.flags import with_flags
from tillroll.operators.anomalies import sale_features
from tillroll.operators.rfm import rfm
from tillroll.operators.segments import SEGMENT_COLUMNS, label_segments
from tillroll.session import new_path
from tillroll.sources.tables import (
    MONTH,
    append_facts,
    drop_folder,
    read_table,
    replace_table,
    shuffles_freed,
)

# Codes planted for parts whose key leaves these remainders on division by 97.
_PLANTED_CODES = {0: "POST", 1: "M", 2: "m", 3: "DOT", 4: "BANK CHARGES"}

# Fixed value: sales above this line value stand in for the flagged ones.
_UNUSUAL_VALUE = 103000

# The keys that make a line's id, after the order, and the factor that makes room for each.
_ID_PARTS = {"l_linenumber": 8, "l_partkey": 32768, "l_suppkey": 1024, "cents_of_id": 100000}

# Room for the lines of one order, where ids are numbered within orders.
_LINES_OF_ORDER = 1 << 20

_stored: dict[tuple[str, str, str], DataFrame] = {}
_storing = Lock()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _packed(lines: DataFrame) -> DataFrame:
    """Lines with ``line_id``, all keys as one number: null where a key is null or it is beyond a bigint."""
    packed = F.col("l_orderkey")
    for name, factor in _ID_PARTS.items():
        packed = F.try_add(F.try_multiply(packed, F.lit(factor)), F.col(name))
    return lines.withColumn("cents_of_id", F.col("cents") % 100000).withColumn("line_id", packed)


def ids_fit(lines: DataFrame) -> bool:
    """Whether the number that all keys make fits for every line, as in tables up to twice sf0.1."""
    known = _packed(lines).dropna(subset=["l_orderkey", *_ID_PARTS])
    return known.filter(F.col("line_id").isNull()).isEmpty()


def with_line_id(lines: DataFrame, fit: bool | None = None) -> DataFrame:
    """Lines with ``line_id``: equal for equal keys, null where a key is null.

    The id is all keys as one number. Where that does not fit for every line of the table (``fit``), the
    ids are the order's key and the line's place in the order instead.
    """
    lines, fit = _packed(lines), ids_fit(lines) if fit is None else fit
    if fit:
        return lines.drop("cents_of_id")
    # Partitioned as the join with the orders wants it, so the lines move once for both.
    place = F.dense_rank().over(Window.partitionBy("l_orderkey").orderBy(*_ID_PARTS)).cast("long")
    known = F.lit(True)
    for name in ("l_orderkey", *_ID_PARTS):
        known = known & F.col(name).isNotNull()
    too_many = F.raise_error(F.lit(f"an order has {_LINES_OF_ORDER} or more different lines"))
    return (
        lines.withColumn("place", place)
        .withColumn("place", F.when(F.col("place") < _LINES_OF_ORDER, F.col("place")).otherwise(too_many))
        .withColumn("line_id", F.when(known, F.col("l_orderkey") * _LINES_OF_ORDER + F.col("place")))
        .drop("cents_of_id", "place")
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        (F.col("l_returnflag") == "R").alias("returned"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"),
        F.col("l_quantity").cast("long").alias("q"),
    )


def with_parts(lines: DataFrame, sf_dir: str) -> DataFrame:
    parts = table(lines.sparkSession, sf_dir, "part").select("p_partkey", "p_name")
    return lines.join(parts, F.col("p_partkey") == F.col("l_partkey")).drop("p_partkey")


def with_orders(lines: DataFrame, sf_dir: str, fit: bool) -> DataFrame:
    """Lines with ids, orders, customers and nations. Orders meet customers first: they are fewer."""
    orders, customers, nations = (
        table(lines.sparkSession, sf_dir, name) for name in ("orders", "customer", "nation")
    )
    placed = (
        orders.join(customers, F.col("c_custkey") == F.col("o_custkey"))
        .join(nations, F.col("n_nationkey") == F.col("c_nationkey"))
        .select("o_orderkey", "o_custkey", "o_orderdate", "n_name")
    )
    lines = with_line_id(lines, fit).drop("l_suppkey")
    hour = (F.col("l_orderkey") % 24).cast("int")
    return (
        lines.join(placed, F.col("o_orderkey") == F.col("l_orderkey"))
        .withColumn("invoice_date", F.timestamp_add("HOUR", hour, "o_orderdate"))
        .drop("o_orderkey", "o_orderdate")
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines from lineitem, orders, customer, nation and part."""
    lines = order_lines(spark, sf_dir)
    return invoice_lines(with_orders(with_parts(lines, sf_dir), sf_dir, ids_fit(lines)))


def invoice_lines(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Transactions with all kinds of defects, of order lines with names. ``keep``: further columns."""
    line = F.col("l_linenumber")
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    returned = F.col("returned")
    prefix = F.when(
        returned & (line <= 2), F.when(order % 2 == 0, F.lit("C")).otherwise(F.lit("c"))
    ).otherwise(F.lit(""))
    code = (part + 10000).cast("string")
    for remainder, planted in _PLANTED_CODES.items():
        code = F.when(part % 97 == remainder, F.lit(planted)).otherwise(code)
    negative = returned & (line <= 3) & ~((line == 1) & (order % 50 == 0))
    unit_cents = F.expr("(cents - cents % q) div q").cast("decimal(20,0)")
    customer = F.col("o_custkey")
    lines = rows.select(
        F.col("line_id").alias("id"),
        F.concat(prefix, (order + 500000).cast("string")).alias("invoice_no"),
        code.alias("stock_code"),
        F.when(part % 50 != 7, F.col("p_name")).alias("description"),
        F.when(negative, -F.col("q")).otherwise(F.col("q")).cast("int").alias("quantity"),
        "invoice_date",
        F.when((order + line) % 150 == 0, F.lit(0))
        .otherwise(unit_cents * F.lit("0.01").cast("decimal(3,2)"))
        .cast("decimal(10,2)")
        .alias("unit_price"),
        F.when(customer % 5 != 0, customer).cast("int").alias("customer_id"),
        F.when(customer % 211 != 1, F.col("n_name")).alias("country"),
        *keep,
    )
    # Some rows occur twice; the second copy goes by the negated id.
    copies = F.when(F.col("id") % 503 == 3, F.array(F.lit(1), F.lit(-1))).otherwise(
        F.array(F.lit(1))
    )
    return lines.withColumn("sign", F.explode(copies)).select(
        (F.col("id") * F.col("sign")).alias("id"), *lines.columns[1:]
    )


def _once(spark: SparkSession, sf_dir: str, name: str, write) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _storing:
        if key not in _stored:
            path = new_path(spark, name)
            write(path)
            # Kept as a frame, so that its files are listed once.
            _stored[key] = read_table(spark, path)
    return _stored[key]


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagged fact table, stored in folders by month."""

    def flagged_lines(rows: DataFrame) -> DataFrame:
        return with_flags(invoice_lines(rows, [MONTH]))

    def write(path: str) -> None:
        # A step at a time, so that its shuffle files go before those of the next are written. Orders come
        # last: their lines then lie together, which makes the move to the months smaller.
        lines = order_lines(spark, sf_dir)
        named, placed = new_path(spark, "named-lines"), new_path(spark, "placed-lines")
        with shuffles_freed(spark):
            with_parts(lines, sf_dir).write.parquet(named, compression="zstd")
            with_orders(spark.read.parquet(named), sf_dir, ids_fit(lines)).write.parquet(
                placed, compression="zstd"
            )
            drop_folder(spark, named)
            append_facts(spark.read.parquet(placed), path, finish=flagged_lines)
            drop_folder(spark, placed)

    return _once(spark, sf_dir, "transactions", write)


def clusters_by_rule(customers: DataFrame) -> DataFrame:
    """A stand-in for a fitted clustering that SQL can state."""
    cluster = (
        F.when((F.col("recency_days") <= 180) & (F.col("frequency") >= 11), 0)
        .when(F.col("recency_days") > 300, 1)
        .otherwise(2)
    )
    return customers.withColumns(
        {"cluster": cluster, "monetary": F.col("monetary").cast("decimal(12,2)")}
    )


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a cluster but no name yet, stored."""
    rows = facts(spark, sf_dir)
    return _once(
        spark,
        sf_dir,
        "clustered",
        lambda path: replace_table(clusters_by_rule(rfm(rows)), path),
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer segment table, stored."""
    rows = clustered(spark, sf_dir)
    return _once(
        spark,
        sf_dir,
        "customer_segments",
        lambda path: replace_table(label_segments(rows).select(*SEGMENT_COLUMNS), path),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in for the model's score table that SQL can state, stored."""
    sales = sale_features(facts(spark, sf_dir), [MONTH])
    over = F.col("total_value") - F.lit(_UNUSUAL_VALUE)
    rule = sales.select(
        F.col("id").alias("transaction_id"),
        (over * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(10,6)").alias(
            "anomaly_score"
        ),
        (F.col("total_value") > _UNUSUAL_VALUE).alias("is_anomaly"),
        MONTH,
    )
    return _once(
        spark, sf_dir, "transaction_anomalies", lambda path: replace_table(rule, path, by=[MONTH])
    )


def narrative_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narratives as reruns leave them, with repeated keys and tied times, from conversations."""
    conversation = F.col("conv_id")
    return table(spark, sf_dir, "conversations").select(
        (conversation * 1000 + F.col("turn")).alias("id"),
        F.col("role").alias("narrative_type"),
        F.when(
            conversation % 7 != 0, F.concat(F.lit("k"), (conversation % 50).cast("string"))
        ).alias("reference_key"),
        stats_of_turn().alias("input_stats"),
        F.col("text").alias("narrative_text"),
        F.timestamp_add(
            "MINUTE",
            F.floor(F.col("turn") / 2).cast("int"),
            F.lit("2024-01-01").cast("timestamp_ntz"),
        ).alias("generated_at"),
    )


def stats_of_turn():
    return F.to_json(F.struct("conv_id", "turn"))
