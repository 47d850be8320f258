"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import difference, duck
from checks.oracle import statements
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(statements()))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, FOLDER, name) is None


def test_all_queries_have_sql():
    assert set(QUERIES) == set(statements())
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
