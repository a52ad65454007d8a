"""Every catalogue query against its DuckDB oracle at sf0.01 (exact values)."""

import pytest

import __spark_entry__ as entry
from conftest import SF001
from oracle_util import compare, duck

QUERIES = {k: q for k, q in entry.queries().items() if k not in entry.LLM_QUERIES}
ORACLE = {k: sql for k, sql in entry.oracle_sql().items() if k not in entry.LLM_QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_oracle_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF001).toPandas()
    want = con.sql(ORACLE[name]).df()
    assert compare(got, want) == []


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["region", "total_profit"]
