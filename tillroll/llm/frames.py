"""Small helpers for frames: intermediate tables, column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import new_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later steps neither repeat the work
    nor depend on the executors that did it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores if ``df`` has such a column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that a result is about to add."""
    taken = {name.lower() for name in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def beside(docs: DataFrame, *names: str) -> DataFrame:
    """The columns ``names``, and every row whole in one struct column ``__row``: operators that add
    columns to this cannot meet those of ``docs``. ``select("__row.*")`` gives the rows back."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *names)


def text_mb(docs: DataFrame, text: str = "text") -> float:
    """Megabytes of text, for choosing how many pieces to cut it into."""
    row = docs.agg(F.sum(F.octet_length(F.col(text)))).first()
    return (row[0] or 0) / 1e6


def unit_from_md5(*parts: Column) -> Column:
    """A number strictly between 0 and 1 that depends on ``parts`` alone, on any engine with MD5."""
    return (bits_from_md5(*parts) + F.lit(0.5)) / F.lit(float(1 << 52))


def bits_from_md5(*parts: Column) -> Column:
    """52 bits of the MD5 of ``parts`` joined by colons, as a number."""
    text = F.concat_ws(":", *[part.cast("string") for part in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")
