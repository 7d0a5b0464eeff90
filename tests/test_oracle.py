"""Two-engine check: every register query against its DuckDB oracle (those of
optional parts have tests of their own)."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry_mod
from regstat.plans import oracle, queries
from regstat.plans.compare import compare, duck

QUERIES = queries.registry()
ORACLE = oracle.build()


@pytest.fixture(scope="module")
def con():
    c = duck(SF_SMALL)
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns[:2] == ["Ar", "Bostedskommune"]
    assert df.count() == 75
