"""Compare a Spark result with DuckDB SQL over the same parquet tables."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

VIEWS = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in VIEWS:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf: pd.DataFrame, cols: list[str]) -> list[tuple]:
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return out


def _key(row):
    return tuple((0, "") if v is None else (1, str(v)) if not isinstance(v, (int, float)) else (1, f"{v:030.10f}") for v in row)


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame, rel_tol: float = 0.0) -> list[str]:
    """Problems found (empty list = match).  ``rel_tol=0`` demands exact values."""
    problems = []
    s_cols, d_cols = sorted(spark_pdf.columns), sorted(duck_pdf.columns)
    if s_cols != d_cols:
        return [f"columns differ: spark={s_cols} duck={d_cols}"]
    if len(spark_pdf) != len(duck_pdf):
        problems.append(f"row count spark={len(spark_pdf)} duck={len(duck_pdf)}")
        return problems
    a = sorted(_rows(spark_pdf, s_cols), key=_key)
    b = sorted(_rows(duck_pdf, s_cols), key=_key)
    bad = 0
    for ra, rb in zip(a, b):
        for c, x, y in zip(s_cols, ra, rb):
            same = x == y
            if not same and isinstance(x, (int, float)) and isinstance(y, (int, float)) and x is not None and y is not None:
                same = math.isclose(float(x), float(y), rel_tol=rel_tol, abs_tol=0.0) if rel_tol else float(x) == float(y)
            if not same:
                bad += 1
                if bad <= 5:
                    problems.append(f"{c}: spark={x!r} duck={y!r}")
    if bad:
        problems.append(f"{bad} differing values")
    return problems
