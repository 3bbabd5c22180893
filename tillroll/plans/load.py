"""Load a raw invoice file into the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.flags import with_flags
from tillroll.session import new_path
from tillroll.sources import raw_invoices, tables


def last_id(spark: SparkSession, facts_path: str) -> int:
    """Highest id in the fact table, 0 where there is no table yet."""
    if not tables.table_exists(spark, facts_path):
        return 0
    return tables.read_table(spark, facts_path).agg(F.max("id")).first()[0] or 0


#: Where the reader keeps records that have fewer or more fields than the header.
_MALFORMED = "__malformed_record"
_FILE = "__file"


def load_invoices(
    spark: SparkSession, raw_path: str, facts_path: str, once: bool = False
) -> DataFrame:
    """Append the usable rows of a raw file, flagged; returns the load report.

    The file is parsed once: the counts are taken while the usable rows are written to the shared
    folder, from where they are numbered and appended. So the report tells of the rows that were
    read, whatever becomes of the file. One row: ``rows_read``, ``rows_kept``, ``rows_dropped``, and
    the records counted by each reason of ``raw_invoices.with_reasons``.

    With ``once`` files whose rows the table already has are left out (``rows_known`` of the report),
    and the load is stored by one commit. A table is loaded with ``once`` always or never.
    """
    if not once and tables.has_ledger(spark, facts_path):
        raise ValueError(f"{facts_path} was loaded with a ledger")
    raw = raw_invoices.read_raw_csv(spark, raw_path, malformed=_MALFORMED)
    typed = raw_invoices.with_reasons(raw, _MALFORMED).withColumn(_FILE, F.input_file_name())
    reasons = typed.schema["reasons"].dataType.names
    counts = raw_invoices.report_counts()
    counts += [F.count_if(F.col("reasons")[name]).alias(name) for name in reasons]
    seen = Observation()
    staged = new_path(spark, "load")
    after = last_id(spark, facts_path)
    # Nothing is shuffled between the file and this write, so each record is counted once.
    usable = typed.observe(seen, *counts).filter(raw_invoices.is_usable()).drop("reasons")
    usable.write.parquet(staged)
    report = dict(seen.get)
    rows = spark.read.schema(usable.schema).parquet(staged)

    def facts(fresh: DataFrame, after: int) -> DataFrame:
        return with_flags(raw_invoices.with_row_id(fresh, after))

    if once:
        # Numbered after what is stored when the load is written, also after another load's commit.
        stored = tables.append_once(
            rows, facts_path, _FILE, lambda fresh: facts(fresh, last_id(spark, facts_path))
        )
        loaded = stored.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        report["rows_known"] = report["rows_kept"] - loaded
    else:
        tables.append_facts(facts(rows.drop(_FILE), after), facts_path)
        report["rows_known"] = 0
    names = ("rows_read", "rows_kept", "rows_dropped", "rows_known", *reasons)
    return spark.createDataFrame(
        [tuple(report[name] for name in names)], ", ".join(f"{name} long" for name in names)
    )
