"""Parquet table access.

Tables are plain parquet scans with a declared schema: no inference job that
reads file footers, and Catalyst prunes each scan to the referenced columns
(``ReadSchema``) and pushes comparisons into the reader (``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlens.schema import EVENTS_SCHEMA


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_S, _I, _L, _D, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()

TABLE_SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(
        ("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I), ("c_acctbal", _D), ("c_mktsegment", _S)
    ),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "part": _schema(
        ("p_partkey", _L),
        ("p_name", _S),
        ("p_brand", _S),
        ("p_type", _S),
        ("p_size", _I),
        ("p_retailprice", _D),
    ),
    "orders": _schema(
        ("o_orderkey", _L),
        ("o_custkey", _L),
        ("o_orderstatus", _S),
        ("o_totalprice", _D),
        ("o_orderdate", _TS),
        ("o_orderpriority", _S),
    ),
    "lineitem": _schema(
        ("l_orderkey", _L),
        ("l_partkey", _L),
        ("l_suppkey", _L),
        ("l_linenumber", _I),
        ("l_quantity", _D),
        ("l_extendedprice", _D),
        ("l_discount", _D),
        ("l_tax", _D),
        ("l_returnflag", _S),
        ("l_linestatus", _S),
        ("l_shipdate", _TS),
    ),
    "events": EVENTS_SCHEMA,
}

TABLES = tuple(TABLE_SCHEMAS)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one driver table (``{sf_dir}/{name}.parquet``)."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(table_path(sf_dir, name))
