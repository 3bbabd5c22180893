"""Writing and reading the fact table and the result tables."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import date, datetime
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

MONTH = "invoice_month"
VERSION = "version"
LOAD = "load"
LEDGER = "_ledger"
#: What the ledger of a fact table says of each file that was loaded.
LEDGER_SCHEMA = StructType(
    [
        StructField(LOAD, StringType()),
        StructField("file", StringType()),
        StructField("rows", LongType()),
        StructField("checksum", StringType()),
    ]
)


def append_facts(
    df: DataFrame,
    path: str,
    mode: str = "append",
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Append one load, in folders by invoice month. Loading twice stores the rows twice.

    ``finish`` makes facts of rows that have reached their month, and keeps the month: what follows from
    a row alone need not move with it.

    The rebalance hint gathers each month before the write, so that a task does not open a file
    for every month, and lets adaptive execution split a month that is too large for one task. Rows are
    ordered by date inside a file, which lets day ranges skip row groups too.
    """
    rows = df.withColumn(MONTH, F.trunc("invoice_date", "month")).hint("rebalance", MONTH)
    if finish:
        rows = finish(rows)
    (
        rows.sortWithinPartitions(MONTH, "invoice_date")
        .write.mode(mode)
        .partitionBy(MONTH)
        .parquet(path)
    )


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """In here a write frees its shuffle files when it ends, instead of whenever the driver collects its
    garbage. Afterwards the session is set as before."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that was written for this application alone."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Versions:
    """The states of a table that is saved whole, each in a folder of its own under ``path``.

    A state counts once its marker, a file named by its number that holds the folder's name, is
    there. Markers are created exclusively, which file systems of a cluster do atomically, so of two
    writers that take the same number one fails and learns of the other. A write that dies leaves the
    states before it as they are. A marker that stays empty is of a writer that died between creating
    and filling it; after ``PATIENCE`` seconds its number is passed over.
    """

    MARKERS = "_versions"
    PATIENCE = 20.0

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self.path = spark, path
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _markers(self) -> dict[int, str]:
        """Number -> folder, empty for a marker that is not filled."""
        found = self._files.globStatus(self._path(f"{self.path}/{self.MARKERS}/[0-9]*")) or ()
        out = {}
        for status in found:
            stream = self._files.open(status.getPath())
            try:
                held = self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            out[int(status.getPath().getName())] = held
        # Histories of before markers: a folder counts by what Spark leaves last.
        old = self._files.globStatus(self._path(f"{self.path}/{VERSION}=*/_SUCCESS")) or ()
        for status in old:
            folder = status.getPath().getParent().getName()
            out.setdefault(int(folder.removeprefix(f"{VERSION}=")), folder)
        return out

    def last(self) -> tuple[int, str | None]:
        """The number to follow and the folder of the last state; 0 and none where there is none."""
        waited = 0.0
        while True:
            markers = self._markers()
            last = max(markers, default=0)
            if not last or markers[last] or waited >= self.PATIENCE:
                filled = [number for number, folder in markers.items() if folder]
                return last, markers[max(filled)] if filled else None
            time.sleep(0.1)
            waited += 0.1

    def write(self, df: DataFrame, by: Sequence[str] = ()) -> str:
        """``df`` in a new folder, which no reader knows yet."""
        folder = f"state-{uuid4().hex}"
        rows = df.hint("rebalance", *by) if by else df
        rows.write.partitionBy(*by).parquet(f"{self.path}/{folder}")
        return folder

    def commit(self, number: int, folder: str) -> bool:
        """Whether ``folder`` became state ``number``; not if there is one already."""
        marker = self._path(f"{self.path}/{self.MARKERS}/{number}")
        try:
            stream = self._files.create(marker, False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            return False
        stream.write(bytearray(folder.encode()))
        stream.close()
        return True

    def drop_before(self, number: int) -> None:
        """Delete the folders of states before ``number``; the markers stay."""
        for own, folder in self._markers().items():
            if own < number and folder:
                self._files.delete(self._path(f"{self.path}/{folder}"), True)


def replace_table(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Rerunnable full replace, in folders ``by`` some columns.

    The new rows are written beside the old ones and become the table by one commit, so a write that
    fails leaves the old table. The state before stays for readers that have begun; older ones go.
    ``df`` may read from ``path``. Of two writers the later commit is the table.
    """
    versions = Versions(df.sparkSession, path)
    folder = versions.write(df, by)
    number = versions.last()[0] + 1
    while not versions.commit(number, folder):
        number += 1
    versions.drop_before(number - 1)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table of files, the last state of one that is replaced as a whole, or of one with a ledger
    the loads that the ledger names."""
    folder = Versions(spark, path).last()[1]
    if folder:
        return spark.read.parquet(f"{path}/{folder}")
    if not has_ledger(spark, path):
        return spark.read.parquet(path)
    loads = [row[0] for row in read_ledger(spark, path).select(LOAD).distinct().collect()]
    return spark.read.parquet(path).filter(F.col(LOAD).isin(loads)).drop(LOAD)


def has_ledger(spark: SparkSession, path: str) -> bool:
    return Versions(spark, f"{path}/{LEDGER}").last()[0] > 0


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The files that were loaded into the fact table at ``path``, with their loads."""
    return read_last_version(spark, f"{path}/{LEDGER}", LEDGER_SCHEMA)


def append_once(
    staged: DataFrame,
    path: str,
    file: str,
    finish: Callable[[DataFrame], DataFrame],
    attempts: int = 20,
) -> DataFrame:
    """Append the rows of files that the table has not seen; returns the ledger's rows of this load.

    ``staged`` is a stored table with the column ``file``; ``finish`` makes facts of its other columns.
    A file is known by the number and the hashes of its rows, whatever its name. The load is written to
    a folder of its own, which readers do not look into before the ledger names it, and one commit of
    the ledger's next state both stores the rows and remembers the files. So a load that dies leaves no
    rows, and of two loads of one file at the same time the second finds it known and adds none.
    """
    spark = staged.sparkSession
    if table_exists(spark, path) and not has_ledger(spark, path):
        raise ValueError(f"{path} was loaded without a ledger")
    row = F.xxhash64(*[F.struct(F.col(name)) for name in staged.columns if name != file])
    checksum = F.concat_ws(
        "-", F.count("*"), F.hex(F.bit_xor(row)), F.sum(row.cast("decimal(38,0)")).cast("string")
    )
    files = staged.groupBy(F.col(file).alias("file")).agg(
        F.count("*").alias("rows"), checksum.alias("checksum")
    )
    # Of equal files the first by name.
    files = files.groupBy("rows", "checksum").agg(F.min("file").alias("file"))
    versions = Versions(spark, f"{path}/{LEDGER}")
    for _ in range(attempts):
        number, folder = versions.last()
        ledger = _state(spark, versions.path, folder, LEDGER_SCHEMA)
        load = f"load-{uuid4().hex}"
        fresh = files.join(ledger.select("checksum"), "checksum", "left_anti").select(
            F.lit(load).alias(LOAD), "file", "rows", "checksum"
        )
        found = fresh.collect()  # one row for each file of the load
        if not found:
            return spark.createDataFrame([], LEDGER_SCHEMA)
        fresh = spark.createDataFrame(found, LEDGER_SCHEMA)
        rows = staged.join(fresh.select(F.col("file").alias(file)), file, "left_semi").drop(file)
        append_facts(finish(rows), f"{path}/{LOAD}={load}", mode="errorifexists")
        if versions.commit(number + 1, versions.write(ledger.unionByName(fresh))):
            return fresh
    raise RuntimeError(f"{path} was loaded into {attempts} times while a load was written")


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        read_table(spark, path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
    return True


def append_version(df: DataFrame, path: str) -> None:
    """Save the next state of a table, beside the older ones, whatever the last one is."""
    versions = Versions(df.sparkSession, path)
    folder = versions.write(df)
    number = versions.last()[0] + 1
    while not versions.commit(number, folder):
        number += 1


def update_versions(
    spark: SparkSession,
    path: str,
    schema: StructType,
    change: Callable[[DataFrame], DataFrame],
    attempts: int = 20,
) -> None:
    """Save ``change(last state)`` as the next state.

    Where another writer has saved one meanwhile, the change is computed anew from that one, so no
    change is lost. After so many ``attempts`` it is given up with an error.
    """
    versions = Versions(spark, path)
    for _ in range(attempts):
        number, folder = versions.last()
        before = _state(spark, path, folder, schema)
        if versions.commit(number + 1, versions.write(change(before))):
            return
    raise RuntimeError(f"{path} changed {attempts} times while a change of it was computed")


def _state(spark: SparkSession, path: str, folder: str | None, schema: StructType) -> DataFrame:
    if folder is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{folder}")


def read_last_version(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The state saved last; no rows where nothing has been saved yet."""
    return _state(spark, path, Versions(spark, path).last()[1], schema)


def _moment(value: str | date | datetime) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def _month_start(value: str | date | datetime) -> Column:
    return F.trunc(F.lit(value).cast("date"), "month")


def in_days(df: DataFrame, first: str | date, last: str | date) -> DataFrame:
    """Rows of the days ``first`` to ``last``, both whole. Folders of other months are not read."""
    day = F.col("invoice_date")
    after = F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz")
    keep = (day >= _moment(first)) & (day < after)
    if MONTH in df.columns:
        keep = keep & F.col(MONTH).between(_month_start(first), _month_start(last))
    return df.filter(keep)


def outside(df: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """Rows with ``invoice_date < start`` or ``invoice_date > end``, to the moment."""
    keep = (F.col("invoice_date") < _moment(start)) | (F.col("invoice_date") > _moment(end))
    if MONTH in df.columns:
        keep = keep & (
            (F.col(MONTH) <= _month_start(start)) | (F.col(MONTH) >= _month_start(end))
        )
    return df.filter(keep)


def export_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with a header. ``files=1`` is for reports of a few rows; details stay partitioned."""
    out = df if files is None else df.coalesce(files)
    out.write.mode("overwrite").options(header=True, escape='"').csv(path)
