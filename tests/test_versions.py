"""States of a table: commits, failures and writers at the same time."""

from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from tillroll.plans import load
from tillroll.session import new_path
from tillroll.sources import tables
from tillroll.sources.tables import Versions

SCHEMA = "id long"


def broken(spark):
    return spark.range(5).withColumn("id", F.raise_error(F.lit("broken")).cast("long"))


def test_a_failed_replace_keeps_the_old_table(spark):
    path = new_path(spark, "t")
    tables.replace_table(spark.range(3), path)
    with pytest.raises(Exception, match="broken"):
        tables.replace_table(broken(spark), path)
    assert tables.read_table(spark, path).count() == 3
    tables.replace_table(tables.read_table(spark, path).filter("id > 0"), path)
    assert tables.read_table(spark, path).count() == 2


def test_only_the_last_two_states_of_a_replaced_table_stay(spark):
    path = new_path(spark, "t")
    for n in range(1, 5):
        begun = tables.read_table(spark, path) if n > 1 else None
        tables.replace_table(spark.range(n), path)
        assert begun is None or begun.count() == n - 1  # a reader that had begun
    files = Versions(spark, path)
    found = files._files.globStatus(files._path(f"{path}/state-*"))
    assert len(found) == 2 and tables.read_table(spark, path).count() == 4


def test_replaced_tables_in_folders(spark):
    path = new_path(spark, "t")
    tables.replace_table(spark.range(10).withColumn("part", F.col("id") % 3), path, by=["part"])
    assert tables.read_table(spark, path).filter("part = 1").count() == 3


def test_a_number_that_is_taken_is_not_taken_again(spark):
    versions = Versions(spark, new_path(spark, "t"))
    assert versions.last() == (0, None)
    assert versions.commit(1, "one") and not versions.commit(1, "two")
    assert versions.last() == (1, "one")


def test_a_writer_that_died_before_it_filled_its_marker(spark, monkeypatch):
    monkeypatch.setattr(Versions, "PATIENCE", 0.3)
    path = new_path(spark, "t")
    tables.append_version(spark.range(2), path)
    versions = Versions(spark, path)
    versions._files.create(versions._path(f"{path}/{Versions.MARKERS}/2"), False).close()
    schema = spark.range(1).schema
    assert tables.read_last_version(spark, path, schema).count() == 2
    tables.update_versions(spark, path, schema, lambda state: state.unionByName(spark.range(7, 8)))
    assert sorted(r.id for r in tables.read_last_version(spark, path, schema).collect()) == [0, 1, 7]


def test_changes_at_the_same_time_are_both_saved(spark):
    """Both read the same state before either saves; the second has to start again."""
    path = new_path(spark, "t")
    schema = spark.range(1).schema
    tables.append_version(spark.range(1), path)
    both_have_read = Barrier(2)
    runs = []

    def save(value):
        first = True

        def change(state):
            nonlocal first
            runs.append(value)
            if first:
                both_have_read.wait(60)
                first = False
            return state.unionByName(spark.range(value, value + 1))

        tables.update_versions(spark, path, schema, change)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(save, (10, 20)))
    assert sorted(r.id for r in tables.read_last_version(spark, path, schema).collect()) == [0, 10, 20]
    assert len(runs) == 3


def test_a_state_that_always_changes_is_given_up(spark):
    path = new_path(spark, "t")

    def change(state):
        tables.append_version(spark.range(1), path)
        return state

    with pytest.raises(RuntimeError, match="changed 2 times"):
        tables.update_versions(spark, path, spark.range(1).schema, change, attempts=2)


# Loads that are stored once ----------------------------------------------------------------------

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country"


def write_raw(folder, name, *numbers):
    folder.mkdir(exist_ok=True)
    lines = [f"{n},A,d,{n},2009-12-0{1 + n % 9} 07:45:00,1.0,7,UK" for n in numbers]
    (folder / name).write_text("\n".join((HEADER, *lines)))
    return str(folder)


def test_a_rerun_adds_no_rows_and_new_files_do(spark, tmp_path):
    path = new_path(spark, "facts")
    raw = write_raw(tmp_path / "raw", "one.csv", 1, 2, 3)
    assert load.load_invoices(spark, raw, path, once=True).first().rows_known == 0
    assert load.load_invoices(spark, raw, path, once=True).first().rows_known == 3
    write_raw(tmp_path / "raw", "renamed.csv", 3, 2, 1)  # the same rows by another name, in another order
    write_raw(tmp_path / "raw", "two.csv", 4, 4, 5)
    report = load.load_invoices(spark, raw, path, once=True).first()
    assert (report.rows_read, report.rows_known) == (9, 6)
    rows = tables.read_table(spark, path).orderBy("id").collect()
    assert [r.id for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [r.invoice_no for r in rows] == ["1", "2", "3", "4", "4", "5"]
    assert "load" not in rows[0].asDict() and tables.read_ledger(spark, path).count() == 2
    with pytest.raises(ValueError, match="with a ledger"):
        load.load_invoices(spark, raw, path)


def test_a_load_that_dies_leaves_no_rows(spark, tmp_path, monkeypatch):
    path = new_path(spark, "facts")
    raw = write_raw(tmp_path / "raw", "one.csv", 1, 2)
    load.load_invoices(spark, raw, path, once=True)
    more = write_raw(tmp_path / "more", "two.csv", 3, 4, 5)

    def die(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched, pytest.raises(KeyboardInterrupt):
        patched.setattr(Versions, "commit", die)  # after the rows were written
        load.load_invoices(spark, more, path, once=True)
    assert tables.read_table(spark, path).count() == 2
    load.load_invoices(spark, more, path, once=True)
    assert [r.id for r in tables.read_table(spark, path).orderBy("id").collect()] == [1, 2, 3, 4, 5]


def test_two_loads_at_the_same_time(spark, tmp_path):
    """One file in both: its rows are stored once, and ids do not meet."""
    path = new_path(spark, "facts")
    first = write_raw(tmp_path / "a", "one.csv", 1, 2, 3)
    write_raw(tmp_path / "b", "one.csv", 1, 2, 3)
    second = write_raw(tmp_path / "b", "two.csv", 4, 5)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda raw: load.load_invoices(spark, raw, path, once=True), (first, second)))
    rows = tables.read_table(spark, path).collect()
    assert sorted(r.invoice_no for r in rows) == ["1", "2", "3", "4", "5"]
    assert sorted(r.id for r in rows) == [1, 2, 3, 4, 5]


def test_a_table_without_a_ledger_gets_none(spark, tmp_path):
    path = new_path(spark, "facts")
    raw = write_raw(tmp_path / "raw", "one.csv", 1)
    load.load_invoices(spark, raw, path)
    with pytest.raises(ValueError, match="without a ledger"):
        load.load_invoices(spark, raw, path, once=True)
