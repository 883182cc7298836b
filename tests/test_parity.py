"""Every registered query against its SQL on the smallest given tables."""

import os

import pytest

from parity.check import connect, differences
from parity.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_agrees(spark, con, name):
    count, diff = differences(spark, con, name, SF_DIR)
    assert count > 0 and not diff, diff


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())
