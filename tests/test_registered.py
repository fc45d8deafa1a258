"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_contract():
    names = entry.queries().keys()
    assert set(entry.oracle_sql()) <= set(names)
    assert len(names) >= 57


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, connection, name):
    problem, n, _ = compare(spark, connection, SF, entry.queries()[name], entry.oracle_sql().get(name))
    assert problem is None
    assert n > 0


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["o_orderstatus", "n_orders", "total", "last_order"]
    assert rows.count() == 3
