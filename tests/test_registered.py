"""Every registered query against its SQL on DuckDB."""

import os

import compare
import pytest

import __spark_entry__ as contract
from dailyfacts.catalogue import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert compare.compare(df, duck, contract.oracle_sql()[name]) == ""


def test_entry(spark):
    days = [row.daterep for row in contract.entry(spark).collect()]
    assert days and days == sorted(days, reverse=True)
