"""Every registered query against its SQL equivalent on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracles import compare, connect

SF = "/root/testdata/sf0.001"
SLOW = set()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in SLOW])
def test_query(spark, con, name):
    ok, message = compare(spark, con, name, SF)
    assert ok, message


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["date", "product_id", "sales"] and rows.count() > 0
