"""Every query with SQL agrees with DuckDB row for row on the smallest table set."""

import pytest

import __spark_entry__ as contract
from codetide.plans.catalogue import QUERIES
from conftest import SF_DIR
from duckdb_queries import ORACLES
from oracle_check import difference


def test_contract_has_all_queries():
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), ORACLES[name], SF_DIR) is None


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
