"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from contract.queries import QUERIES
from contract.sql import SQL
from tools.compare import compare, connect

# Iterative fits, whose results are checked by property in their own tests.
FITS = {"r4_k_sweep", "r6_kmeans_segments", "a3_isolation_forest", "a4_anomaly_scores"}


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


def test_only_the_fits_lack_sql():
    assert set(QUERIES) - set(SQL) == FITS
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, db, sf, name):
    good, note = compare(spark, db, name, sf)
    assert good, note
