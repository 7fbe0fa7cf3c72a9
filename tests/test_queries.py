"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_point
from checks.compare import as_bag, expected, tables
from checks.queries import QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def connection():
    return tables(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert QUERIES.keys() <= entry_point.oracle_sql().keys()


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[:3] == ["window_start", "window_end", "wiki"]
    assert df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    assert as_bag(df.columns, df.collect()) == expected(connection, entry_point.oracle_sql()[name])
