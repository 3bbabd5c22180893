from datetime import datetime
from decimal import Decimal

import pytest

from tillroll.plans import load
from tillroll.schema import SOURCE_COLUMNS
from tillroll.session import new_path
from tillroll.sources import raw_invoices as ri
from tillroll.sources import tables

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country"


def write(tmp_path, *lines, header=HEADER):
    path = tmp_path / "raw.csv"
    path.write_bytes("\n".join((header, *lines)).encode("latin-1"))
    return str(path)


def typed(spark, path):
    return ri.coerce_types(ri.read_raw_csv(spark, path))


def test_reads_latin_1_and_types(spark, tmp_path):
    path = write(tmp_path, "489434,85048,CAFÉ LIGHTS,12,2009-12-01 07:45:00,6.95,13085.0,France")
    row = typed(spark, path).first()
    assert row.description == "CAFÉ LIGHTS"
    assert row.invoice_date == datetime(2009, 12, 1, 7, 45)
    assert (row.quantity, row.unit_price, row.customer_id) == (12, Decimal("6.95"), 13085)


def test_columns_are_found_by_name(spark, tmp_path):
    path = write(
        tmp_path,
        "x,France,13085,6.95,2009-12-01 07:45,12,LIGHTS,85048,489434",
        header="Extra," + ",".join(reversed(HEADER.split(","))),
    )
    row = typed(spark, path).first()
    assert row.invoice_no == "489434" and row.country == "France" and row.quantity == 12


def test_quotes_are_doubled_and_numbers_are_plain(spark, tmp_path):
    path = write(
        tmp_path,
        '1,A,"12"" RULER, ""OAK""",5d,2009-12-01 07:45:00,1.0,0x1p3,UK',
        '1,A,back\\slash,1e1,2009-12-01 07:45:00,1.0, 7 ,UK',
    )
    rows = typed(spark, path).collect()
    assert rows[0].description == '12" RULER, "OAK"' and rows[1].description == "back\\slash"
    assert [r.quantity for r in rows] == [None, 10]
    assert [r.customer_id for r in rows] == [None, 7]


def test_texts_with_line_ends_are_whole_or_an_error(spark, tmp_path):
    path = write(
        tmp_path,
        '1,A,"two',
        'lines",1,2009-12-01 07:45:00,1.0,7,UK',
        "2,B,one,1,2009-12-01 07:45:00,1.0,7,UK",
    )
    rows = typed(spark, path).collect()
    assert [r.invoice_no for r in rows] == ["1", "2"] and rows[0].description == "two\nlines"
    with pytest.raises(Exception, match="(?i)malformed"):
        ri.coerce_types(ri.read_raw_csv(spark, path, multiline=False)).collect()


def test_files_with_other_headers_are_an_error(spark, tmp_path):
    write(tmp_path, "1,A,d,1,2009-12-01 07:45:00,1.0,7,UK")
    other = HEADER.replace("Invoice,StockCode", "StockCode,Invoice")
    (tmp_path / "second.csv").write_text(f"{other}\nCODE,99,d,1,2009-12-01 07:45:00,1.0,7,UK")
    with pytest.raises(Exception, match="(?i)header"):
        typed(spark, str(tmp_path)).collect()


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("12/1/2010 8:26", datetime(2010, 12, 1, 8, 26)),
        ("12/1/2010 8:26 AM", datetime(2010, 12, 1, 8, 26)),
        ("12/1/2010 12:05 am", datetime(2010, 12, 1, 0, 5)),
        ("12/1/2010 8:26:09PM", datetime(2010, 12, 1, 20, 26, 9)),
        ("12/1/10 8:26", datetime(2010, 12, 1, 8, 26)),
        ("1/2/98", datetime(1998, 1, 2)),
        ("13/12/2009 8:26", datetime(2009, 12, 13, 8, 26)),
        ("2009-12-01T07:45:00", datetime(2009, 12, 1, 7, 45)),
        ("13/13/2009 8:26", None),
        ("12/1/2010 18:26 PM", None),
        ("12/1/2010 25:00", None),
    ],
)
def test_date_forms(spark, tmp_path, text, want):
    path = write(tmp_path, f"1,A,d,1,{text},1.0,7,UK")
    assert typed(spark, path).first().invoice_date == want


def test_missing_column_is_an_error(spark, tmp_path):
    path = write(tmp_path, "1,2", header="Invoice,StockCode")
    with pytest.raises(ValueError, match="unit_price"):
        ri.read_raw_csv(spark, path)


def test_bad_values_become_null(spark, tmp_path):
    path = write(
        tmp_path,
        "1,A,d,many,2009-12-01 07:45:00,1.0,,UK",
        "1,A,d,1,yesterday,1.0,12346.5,UK",
        "1,A,d,1,12/1/2009 7:45,free,12346.0,UK",
        "1,A,nan,2.0,2009-12-01,1.005,abc,NA",
    )
    rows = typed(spark, path).collect()
    assert [r.quantity for r in rows] == [None, 1, 1, 2]
    assert [r.customer_id for r in rows] == [None, None, 12346, None]
    assert rows[1].invoice_date is None
    assert rows[2].invoice_date == datetime(2009, 12, 1, 7, 45)
    assert rows[2].unit_price is None and rows[3].unit_price == Decimal("1.01")
    assert rows[3].description is None and rows[3].country is None


def test_unusable_rows_are_dropped_and_counted(spark, tmp_path):
    path = write(
        tmp_path,
        "1,A,d,1,2009-12-01 07:45:00,1.0,,",
        "1,A,,1,2009-12-01 07:45:00,0,,",
        ",A,d,1,2009-12-01 07:45:00,1.0,7,UK",
        "1,A,d,1,never,1.0,7,UK",
    )
    rows = typed(spark, path)
    assert ri.drop_unusable(rows).count() == 2
    assert ri.load_report(rows).first().asDict() == {
        "rows_read": 4,
        "rows_kept": 2,
        "rows_dropped": 2,
    }


def test_empty_file(spark, tmp_path):
    rows = typed(spark, write(tmp_path))
    assert rows.columns == list(SOURCE_COLUMNS.values())
    assert ri.load_report(rows).first().rows_read == 0


def test_row_ids_follow_the_content_under_any_split(spark):
    rows = [
        (f"{i % 40}", f"S{i % 3}", None if i % 7 == 0 else "d", i % 5, datetime(2010, 1 + i % 3, 1), Decimal("1.50"), i % 2 or None, "UK")
        for i in range(400)
    ]
    schema = "invoice_no string, stock_code string, description string, quantity int, invoice_date timestamp_ntz, unit_price decimal(10,2), customer_id int, country string"
    df = spark.createDataFrame(rows, schema)
    want = None
    for parts in (1, 7, 50, 7):
        got = sorted((tuple(r) for r in ri.with_row_id(df.repartition(parts), 100).collect()), key=lambda r: r[0])
        assert [r[0] for r in got] == list(range(101, 501))
        assert got == (want or got)
        want = got
    dates = [r[1:][df.columns.index("invoice_date")] for r in want]
    assert dates == sorted(dates)
    assert ri.with_row_id(df.limit(0), 100).collect() == []


def test_the_report_is_of_the_rows_that_were_stored(spark, tmp_path):
    """One reading of the file: the report stands when the file is gone."""
    lines = [
        "1,A,d,1,2009-12-01 07:45:00,1.0,7,UK",
        "1,A,d,1,2009-12-01 07:45:00,1.0,7",  # fields missing at the end
        "1,A,d,1,2009-12-01 07:45:00,1.0,7,UK,more",
        ",A,d,1,2009-12-01 07:45:00,1.0,7,UK",
        "2,NA,d,many,never,free,7,UK",
        "2,A,d,99999999999,2009-12-01,123456789.99,7,UK",
        "2,A",
    ]
    path = write(tmp_path, *lines)
    facts = new_path(spark, "facts")
    report = load.load_invoices(spark, path, facts)
    (tmp_path / "raw.csv").unlink()
    found = {name: n for name, n in report.first().asDict().items() if n}
    assert found == {
        "rows_read": 7,
        "rows_kept": 3,
        "rows_dropped": 4,
        "malformed": 3,
        "invoice_no_missing": 1,
        "stock_code_missing": 1,
        "quantity_unreadable": 1,
        "quantity_out_of_range": 1,
        "quantity_missing": 1,
        "invoice_date_unreadable": 1,
        "invoice_date_missing": 1,
        "unit_price_unreadable": 1,
        "unit_price_out_of_range": 1,
        "unit_price_missing": 1,
    }
    stored = tables.read_table(spark, facts)
    assert stored.count() == 3 and {r.id for r in stored.collect()} == {1, 2, 3}
    assert load.load_invoices(spark, write(tmp_path), facts).first().rows_read == 0
    assert load.load_invoices(spark, write(tmp_path, lines[0]), facts).first().rows_kept == 1
    assert {r.id for r in tables.read_table(spark, facts).collect()} == {1, 2, 3, 4}


def test_append_keeps_and_replace_replaces(spark, tmp_path):
    load = ri.drop_unusable(
        typed(spark, write(tmp_path, "1,A,d,1,2009-12-01 07:45:00,1.0,7,UK"))
    )
    path = new_path(spark, "t")
    tables.append_facts(load, path)
    tables.append_facts(load, path)
    assert tables.read_table(spark, path).count() == 2
    path = new_path(spark, "t")
    tables.replace_table(load, path)
    tables.replace_table(load, path)
    assert tables.read_table(spark, path).count() == 1


def test_export_writes_one_file_with_header(spark):
    path = new_path(spark, "csv")
    tables.export_csv(spark.range(3), path, files=1)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["id"] and back.count() == 3 and len(back.inputFiles()) == 1


def test_day_ranges_are_whole_days_and_prune_months(spark):
    rows = spark.sql(
        "SELECT id, timestamp_ntz'2010-01-31 12:00:00' + make_interval(0, 0, 0, id) AS invoice_date"
        " FROM range(60)"
    )
    path = new_path(spark, "t")
    tables.append_facts(rows, path)
    stored = tables.read_table(spark, path)
    assert tables.in_days(stored, "2010-02-01", "2010-02-03").count() == 3
    assert tables.in_days(rows, "2010-02-01", "2010-02-03").count() == 3
    # noon of the last day lies after its midnight
    assert tables.outside(stored, "2010-02-01", "2010-02-03").count() == 58
    assert tables.outside(rows, "2010-02-01", "2010-02-03").count() == 58
    plan = tables.in_days(stored, "2010-02-01", "2010-02-03")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(invoice_month" in plan


ROW = "1,A,d,1,2009-12-01 07:45:00,1.0,7,UK"
PLAIN = [ROW, '2,B,"a ""b"", c",2,2009-12-01,1.0,7,"UK"', "", '"3",,"",x,never,1.0,7', "4,B,d'e,1,2009-12-01,1.0,7,UK,more"]


@pytest.mark.parametrize(
    ("lines", "end", "split"),
    [
        (PLAIN, "\n", True),
        (PLAIN, "\r\n", True),
        ([*PLAIN, '5,B,"two', 'lines",1,2009-12-01,1.0,7,UK'], "\n", False),
        ([*PLAIN, '5,B,12" RULER,1,2009-12-01,1.0,7,UK'], "\n", False),
        ([*PLAIN, '5,B,a"b,"open', 'end",1,2009-12-01,1.0,7,UK'], "\n", False),
        ([*PLAIN, "  ", ROW], "\n", False),
        ([*PLAIN, "5,B,a\rb,1,2009-12-01,1.0,7,UK"], "\n", False),
        ([*PLAIN, ROW + "\r", ROW], "\n", False),
        ([], "\n", True),
    ],
)
def test_files_are_split_only_where_the_rows_are_the_same(spark, tmp_path, lines, end, split):
    path = tmp_path / "raw.csv"
    path.write_bytes(end.join((HEADER, *lines)).encode("latin-1"))
    assert ri.rows_end_at_lines(spark, str(path)) == split
    read = [
        sorted(map(str, ri.read_raw_csv(spark, str(path), multiline=how, malformed="m").collect()))
        for how in (None, True)
    ]
    assert read[0] == read[1]


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    path = write(tmp_path, *[ROW] * 20_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        assert ri.read_raw_csv(spark, path).rdd.getNumPartitions() > 4
        assert ri.read_raw_csv(spark, path, multiline=True).rdd.getNumPartitions() == 1
        assert ri.read_raw_csv(spark, path).count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
