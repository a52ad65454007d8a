"""Driver contract: keys, callables, entry schema and output column names."""

import re

import __spark_entry__ as entry
from conftest import SF0001

NAME = re.compile(r"^[a-z][a-z0-9_]*$")


def test_queries_and_oracle_keys_match():
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries)
    assert set(queries) - set(entry.LLM_QUERIES) == set(oracle) - set(entry.LLM_ORACLE_SQL)
    assert all(callable(f) for f in queries.values())
    assert all(isinstance(sql, str) and sql.strip() for sql in oracle.values())


def test_entry_schema_is_stable(spark):
    df = entry.entry(spark)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("region", "string"),
        ("total_profit", "double"),
    ]


def test_batch_outputs_have_plain_unique_names(spark):
    for name, build in entry.queries().items():
        if name.startswith("stream_") or name in entry.LLM_QUERIES:
            continue  # these run a pipeline; their names are checked by the oracle tests
        cols = build(spark, SF0001).columns
        assert len(cols) == len(set(cols)), name
        assert all(NAME.match(c) for c in cols), (name, cols)


def test_bench_prints_one_json_line():
    import json
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(
        os.environ,
        BENCH_SF_DIR=SF0001,
        BENCH_CPUS="2",
        BENCH_RUNS="1",
        BENCH_QUERIES="row_count,profit_by_region",
    )
    out = subprocess.run(
        [sys.executable, os.path.join(root, "bench.py")],
        env=env, capture_output=True, text=True, timeout=600,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == "0.001"
    assert set(result["queries"]) == {"row_count", "profit_by_region"}
    assert abs(result["value"] - sum(result["queries"].values())) < 1e-3
