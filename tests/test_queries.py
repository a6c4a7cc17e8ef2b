"""Every registered query against its SQL twin."""

import os

import pytest

import __spark_entry__ as entry_module
import oracle

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    assert oracle.difference(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.count() > 0
    assert "quick_ratio" in result.columns
