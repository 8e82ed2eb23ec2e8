"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from compare import database, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(contract.queries())


@pytest.fixture(scope="module")
def duck():
    return database(SF_DIR)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_checks_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert contract.queries()[name](spark, SF_DIR).count() > 0
    else:
        assert difference(spark, duck, contract.queries()[name], sql, SF_DIR) is None
