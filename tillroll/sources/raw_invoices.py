"""Reading raw invoice files and turning their text into typed rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.schema import REQUIRED_COLUMNS, SOURCE_COLUMNS
from tillroll.session import new_path

# The order in which the rows of a load are numbered; equal rows are interchangeable.
ID_ORDER = (
    "invoice_date",
    "invoice_no",
    "stock_code",
    "quantity",
    "unit_price",
    "customer_id",
    "description",
    "country",
)

# Fixed value: encoding of the source files.
SOURCE_ENCODING = "ISO-8859-1"

# Texts that the usual CSV readers of data frames take for a missing value.
MISSING_TEXTS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# What counts as a number; the engine's own cast also takes Java spellings such as "5d".
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Dates with slashes, as spreadsheets write them: month first where that is a date, else day first;
# years of two or four digits; a time of 24 hours, or of 12 with AM or PM.
_SLASH_DATE = (
    r"^\s*(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})"
    r"(?:[ T]+(\d{1,2}):(\d{2})(?::(\d{2}))?\s*([AaPp][Mm])?)?\s*$"
)
# Two-digit years below this are of this century.
_PIVOT_YEAR = 69


# A quoted field, whole: in a record that is all on one line no other quotes are left.
_QUOTED = r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|$)'


def rows_end_at_lines(spark: SparkSession, path: str) -> bool:
    """Whether every record of the files stands on one line, so that a file can be split at line ends.

    One pass over the lines, without parsing: there must be no quote outside of fields that a line
    quotes whole, no line of white space only, and line ends of one kind in each file (the last line
    may have none).
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    line = F.regexp_replace("value", "\r$", "")
    odd = (
        F.regexp_replace(line, _QUOTED, "$1").contains('"')
        | line.contains("\r")
        | ((F.trim(line) == "") & (line != ""))
    )
    returns = F.col("value").endswith("\r")
    files = lines.groupBy(F.input_file_name().alias("file")).agg(
        F.count_if(odd).alias("odd"), F.count_if(returns).alias("crlf"), F.count_if(~returns).alias("lf")
    )
    mixed = (F.col("crlf") > 0) & (F.col("lf") > 1)
    return files.filter((F.col("odd") > 0) | mixed).isEmpty()


def read_raw_csv(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, str] = SOURCE_COLUMNS,
    encoding: str = SOURCE_ENCODING,
    multiline: bool | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """All columns as text, located by header name. Types come later, so no inference pass.

    A quote inside a quoted text is doubled, and a quoted text may hold line ends. If a first pass over
    the lines finds that none does, large files are split at line ends; else each file is read whole,
    by one task. The rows are the same. ``multiline`` says which, without that pass; rows that are said
    to end at line ends but lack fields, as one cut inside quotes does, are then an error. Files whose
    headers differ from the first one's are an error as well. ``malformed`` names a column to add: the
    whole record where it has more or fewer fields than the header, else null.
    """
    options = {"header": True, "encoding": encoding, "escape": '"', "enforceSchema": False}
    mode = "FAILFAST" if multiline is False else "PERMISSIVE"
    if multiline is None:
        multiline = not rows_end_at_lines(spark, path)
    reader = spark.read.options(**options, multiLine=multiline, mode=mode)
    raw = reader.csv(path)
    if malformed is None:
        return select_source_columns(raw, columns)
    # Whether a record has all fields shows only if all are parsed.
    kept = {"columnNameOfCorruptRecord": malformed, "columnPruning": False}
    whole = StructType(raw.schema.fields).add(malformed, "string")
    raw = reader.options(**kept).schema(whole).csv(path)
    return select_source_columns(raw, {**columns, malformed: malformed})


def select_source_columns(
    raw: DataFrame, columns: Mapping[str, str] = SOURCE_COLUMNS
) -> DataFrame:
    """Rename to the table's names and drop all else; a missing column is an error."""
    renamed = raw.withColumnsRenamed(dict(columns))
    missing = sorted(set(columns.values()) - set(renamed.columns))
    if missing:
        raise ValueError(f"missing columns {missing}; found {renamed.columns}")
    return renamed.select(*columns.values())


def _present(name: str) -> Column:
    return F.when(~F.col(name).isin(*MISSING_TEXTS), F.col(name))


def _number(name: str) -> Column:
    return F.when(F.col(name).rlike(_NUMBER), F.col(name)).try_cast("double")


def _whole_number(name: str) -> Column:
    # Identifiers may read as "12346.0"; a fraction is no identifier.
    number = _number(name)
    return F.when(number == F.floor(number), number.try_cast("int"))


def _date_time(name: str) -> Column:
    def part(i: int) -> Column:
        return F.coalesce(F.regexp_extract(name, _SLASH_DATE, i).try_cast("int"), F.lit(0))

    year = F.when(
        F.length(F.regexp_extract(name, _SLASH_DATE, 3)) == 2,
        part(3) + F.when(part(3) < _PIVOT_YEAR, 2000).otherwise(1900),
    ).otherwise(part(3))
    half = F.lower(F.regexp_extract(name, _SLASH_DATE, 7))
    hour = (
        F.when((half != "") & ~part(4).between(1, 12), F.lit(None))
        .when(half == "pm", part(4) % 12 + 12)
        .when(half == "am", part(4) % 12)
        .otherwise(part(4))
    )
    rest = (hour, part(5), part(6).cast("decimal(16,6)"))
    return F.coalesce(
        F.col(name).try_cast("timestamp_ntz"),
        F.try_make_timestamp_ntz(year, part(1), part(2), *rest),
        F.try_make_timestamp_ntz(year, part(2), part(1), *rest),
    )


def coerce_types(raw: DataFrame) -> DataFrame:
    """Give every column its type; a text that does not parse becomes NULL."""
    return raw.select(*coerce_columns())


def coerce_columns() -> list[Column]:
    return [
        _present("invoice_no").alias("invoice_no"),
        _present("stock_code").alias("stock_code"),
        _present("description").alias("description"),
        F.round(_number("quantity")).try_cast("int").alias("quantity"),
        _date_time("invoice_date").alias("invoice_date"),
        F.col("unit_price").try_cast("decimal(10,2)").alias("unit_price"),
        _whole_number("customer_id").alias("customer_id"),
        _present("country").alias("country"),
    ]


def drop_unusable(typed: DataFrame) -> DataFrame:
    """Drop rows lacking a core field."""
    return typed.dropna(subset=list(REQUIRED_COLUMNS))


def is_usable() -> Column:
    """Whether a typed row has all core fields."""
    usable = F.lit(True)
    for name in REQUIRED_COLUMNS:
        usable = usable & F.col(name).isNotNull()
    return usable


def report_counts() -> list[Column]:
    """Rows read, rows kept, rows dropped for lack of a core field."""
    return [
        F.count("*").alias("rows_read"),
        F.count_if(is_usable()).alias("rows_kept"),
        F.count_if(~is_usable()).alias("rows_dropped"),
    ]


def load_report(typed: DataFrame) -> DataFrame:
    """One row: rows read, rows kept, rows dropped for lack of a core field."""
    return typed.agg(*report_counts())


def with_reasons(raw: DataFrame, malformed: str) -> DataFrame:
    """``raw`` with its types, and ``reasons``: a struct of booleans that say what a record lacks.

    For each core field ``<field>_missing`` (no text) and ``<field>_unreadable`` (a text that does not
    parse); for the two numbers ``<field>_out_of_range`` (one that its type cannot hold) as well; and
    ``malformed`` (fewer or more fields than the header). Several may hold of one record.
    """
    texts = raw.select(
        F.struct(*[F.col(name) for name in REQUIRED_COLUMNS]).alias("__text"),
        F.col(malformed).isNotNull().alias("__malformed"),
        *[F.col(name) for name in raw.columns if name != malformed],
    )
    both = texts.select("__text", "__malformed", *coerce_columns())
    reasons = [F.col("__malformed").alias("malformed")]
    for name in REQUIRED_COLUMNS:
        text = F.col("__text")[name]
        absent = text.isNull() | text.isin(*MISSING_TEXTS)
        lost = ~absent & F.col(name).isNull()
        large = F.lit(False)
        if name in ("quantity", "unit_price"):
            large = lost & text.rlike(_NUMBER)
            reasons.append(large.alias(f"{name}_out_of_range"))
        reasons.append(absent.alias(f"{name}_missing"))
        reasons.append((lost & ~large).alias(f"{name}_unreadable"))
    typed = [name for name in both.columns if not name.startswith("__")]
    return both.select(*typed, F.struct(*reasons).alias("reasons"))


def with_row_id(df: DataFrame, after: int = 0) -> DataFrame:
    """Number the rows of one load from ``after`` + 1 on, without gaps, in the order of their content.

    A row's id is its rank in ``ID_ORDER``, so it is the same however the load is split, and in a
    rerun; equal rows share out the ids between them. The rows are range-sorted once and stored;
    how many each sorted partition has says where its numbers begin. A range sort reads its input
    twice: hand in a stored table.
    """
    spark = df.sparkSession
    columns = [name for name in ID_ORDER if name in df.columns]
    order = [F.asc_nulls_first(name) for name in (*columns, *sorted(set(df.columns) - set(columns)))]
    path = new_path(spark, "sorted-load")
    ranked = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranked.withColumn("__row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    # The upper bits of the number are those of the partition, the lower 33 count within it.
    part, nth = F.shiftright("__row", 33), F.col("__row").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    # One row for each partition of the sort.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("__part"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    return (
        rows.withColumn("__part", part)
        .join(starts, "__part")
        .select((nth + F.col("__before") + F.lit(after + 1)).alias("id"), *df.columns)
    )
