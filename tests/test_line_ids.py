"""Retail tables whose keys as one number are beyond a bigint."""

from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from contract.queries import QUERIES
from contract.sql import SQL
from tillroll.functions.flags import with_flags
from tillroll.operators import anomalies
from tillroll.sources import testtables
from tools.compare import rows_of

READ_FACTS = [
    name for name in QUERIES
    if name[0] in "ad" and name != "d6_latest_narratives" or name[:2] in ("f1", "f2", "f3", "f4", "f5")
]
# A multiple of all that the defects divide orders by, so that only ids and invoices change.
FAR = 600 * 5000


def write_tables(spark, path, first_order):
    day = datetime(1996, 1, 1)
    orders = [(first_order + i, i % 17, day + timedelta(days=i % 400)) for i in range(300)]
    lines = [
        (order, n, 7 * (order % 300) + n, n, float(n), 26000.0 * n + i, "RAN"[(i + n) % 3])
        for i, (order, _, _) in enumerate(orders)
        for n in (1, 2, 3, 4)
    ]
    # A line of which all but part and supplier repeat, and one that repeats whole.
    lines += [(first_order, 1, 9, 5, 1.0, 100.0, "R"), lines[5]]
    tables = {
        "lineitem": (lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, "
                            "l_quantity double, l_extendedprice double, l_returnflag string"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "customer": ([(i, i % 3) for i in range(17)], "c_custkey long, c_nationkey int"),
        "nation": ([(i, f"N{i}") for i in range(3)], "n_nationkey int, n_name string"),
        "part": ([(i, f"part {i}") for i in range(2200)], "p_partkey long, p_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(2).write.parquet(f"{path}/{name}.parquet")
    return str(path), lines


@pytest.fixture(scope="module")
def near(spark, tmp_path_factory):
    return write_tables(spark, tmp_path_factory.mktemp("near"), 0)


@pytest.fixture(scope="module")
def far(spark, tmp_path_factory):
    return write_tables(spark, tmp_path_factory.mktemp("far"), FAR)


def originals(spark, path):
    return testtables.transactions(spark, path).filter("id > 0")


def test_ids_that_fit_are_all_keys_as_one_number(spark, near):
    path, lines = near
    want = sorted(
        (((order * 8 + n) * 32768 + part) * 1024 + supplier) * 100000 + round(price * 100) % 100000
        for order, n, part, supplier, _, price, _ in lines
    )
    assert sorted(row.id for row in originals(spark, path).collect()) == want


def test_ids_beyond_a_bigint_differ_where_keys_do(spark, near, far):
    assert ((FAR * 8 * 32768) * 1024) * 100000 >= 1 << 63
    path, lines = far
    rows = originals(spark, path).collect()
    assert len(rows) == len(lines)
    assert len({row.id for row in rows}) == len(set(lines)) == len(lines) - 1
    # Of two loads of the same tables each gives the same ids.
    again = originals(spark, path).repartition(7).collect()
    assert sorted(rows, key=str) == sorted(again, key=str)

    def rest(where):
        return sorted(str(row) for row in originals(spark, where).drop("id", "invoice_no").collect())

    assert rest(path) == rest(near[0])
    copies = testtables.transactions(spark, path).filter("id < 0")
    assert copies.count() == sum(row.id % 503 == 3 for row in rows) > 0


def test_a_line_without_a_key_has_no_id(spark):
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, cents long"
    for order in (FAR, 5):
        rows = [(order, 1, 2, 3, 4), (order, 1, 2, None, 4), (order, None, 2, 3, 4), (order, 1, 2, 3, None)]
        got = testtables.with_line_id(spark.createDataFrame(rows, schema))
        assert got.agg(F.count("*"), F.count("line_id")).first() == (4, 1)


@pytest.mark.parametrize("name", READ_FACTS)
def test_queries_over_keys_beyond_a_bigint(spark, far, name):
    assert QUERIES[name](spark, far[0]).collect()


# The id of the SQL, and the one that stands for it where that is beyond a bigint.
PACKED = "(((ok * 8 + ln) * 32768 + pk) * 1024 + sk) * 100000 + cents % 100000 AS id"
PLACED = (
    "ok * 1048576 + dense_rank() OVER (PARTITION BY ok ORDER BY ln, pk, sk, cents % 100000) AS id"
)
# Queries whose whole results were compared over large tables too.
LIKE_SQL = [
    "a11_customer_concentration",
    "a1_sale_features",
    "a2_log_features",
    "a5_flag_top_share",
    "a6_top_anomalies",
    "a7_score_table",
    "a8_flagged_detail",
    "a9_anomaly_overview",
    "d1_daily_revenue",
    "d2_top_products",
    "d3_monthly_revenue",
    "d4_headline_figures",
    "d5_sliced_daily_revenue",
    "d5_sliced_headline_figures",
    "d5_sliced_monthly_revenue",
    "d5_sliced_top_products",
    "f1_is_cancellation",
    "f2_is_missing_customer",
    "f3_is_return",
    "f5_is_non_product",
]
LIKE_FITS = [
    "a3_isolation_forest",
    "a4_anomaly_scores",
]


@pytest.mark.parametrize("name", LIKE_SQL)
def test_results_over_keys_beyond_a_bigint_equal_the_sql(spark, far, name):
    db = duckdb.connect()
    for table in ("lineitem", "orders", "customer", "nation", "part"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{far[0]}/{table}.parquet/*.parquet'")
    assert SQL[name].count(PACKED) == 1
    want = db.execute(SQL[name].replace(PACKED, PLACED))
    got = QUERIES[name](spark, far[0])
    assert rows_of(got.columns, got.collect()) == rows_of(
        [d[0] for d in want.description], want.fetchall()
    )


@pytest.mark.parametrize("name", LIKE_FITS)
def test_fits_over_keys_beyond_a_bigint_are_of_the_lines_as_derived(spark, far, name):
    rows = with_flags(testtables.transactions(spark, far[0]))
    want = anomalies.fit_sales_forest(rows)
    if name == "a4_anomaly_scores":
        want = anomalies.score_sales(rows, want)
        assert want.count() == anomalies.sale_features(rows).count()
    got = QUERIES[name](spark, far[0])
    assert got.columns == want.columns
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str) != []
