"""Every query of the subpackage that has SQL, against it."""

import pytest

from tillroll.llm.queries import QUERIES
from tillroll.llm.sql import SQL
from tools.compare import compare, connect


def test_each_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf, name):
    good, note = compare(spark, connect(sf), name, sf)
    assert good, note
