"""Every catalogue query against its DuckDB oracle on the smallest data set."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from oracle_check import compare, duck

import __spark_entry__ as entry
from tidemark.plans import catalog, oracle

QUERIES = catalog.QUERIES
ORACLE = oracle.ORACLE_SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, SF_SMALL, name, QUERIES[name], ORACLE.get(name), con)
    assert res["status"].startswith("OK"), res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "sales_amount" in df.columns
