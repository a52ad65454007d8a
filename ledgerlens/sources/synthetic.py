"""Deterministic synthetic sales rows, a pure function of a row index.

Used as a demo source when no sales file exists.  Each row depends only on its
index ``i``, so the generator is a projection over any index column
(``spark.range(n)`` or keys taken from a table) and runs fully in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schema as S
from ledgerlens.sources.csv import read_sales_csv

# Fixed values of the demo data set (must stay as they are for equal output).
DEMO_REGIONS = [
    ("Asia", "India"),
    ("Europe", "Germany"),
    ("Sub-Saharan Africa", "Nigeria"),
    ("Middle East and North Africa", "Egypt"),
    ("North America", "United States"),
    ("Central America and the Caribbean", "Mexico"),
]
DEMO_ITEM_TYPES = ["Office Supplies", "Cosmetics", "Household", "Baby Food", "Clothes"]
DEMO_CHANNELS = ["Online", "Offline"]
DEMO_PRIORITIES = ["L", "M", "H", "C"]
DEMO_START = "2022-01-01"
DEMO_ROWS = 360
DEMO_ORDER_ID_BASE = 100000
DEMO_COST_RATIO = "0.62"


def _pick(values: list[str], i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(i, F.lit(len(values))) + 1).cast("int"))


def synthetic_sales_from_index(df: DataFrame, index_col: str) -> DataFrame:
    """One synthetic sales row per input row, driven by ``index_col``."""
    i = F.col(index_col).cast("bigint")
    units = (F.lit(60) + F.pmod(i, F.lit(140))).cast(S.UNITS_TYPE)
    price = (F.lit(20) + F.pmod(i * 3, F.lit(80))).cast(T.DecimalType(12, 2))
    cost = F.round(price * F.lit(DEMO_COST_RATIO).cast(T.DecimalType(4, 2)), 2)
    revenue = F.round(units * price, 2).cast(S.MONEY_TYPE)
    total_cost = F.round(units * cost, 2).cast(S.MONEY_TYPE)
    order_date = F.date_add(F.lit(DEMO_START).cast("date"), i.cast("int"))
    ship_date = F.date_add(order_date, (F.pmod(i, F.lit(7)) + 1).cast("int"))
    return df.select(
        _pick([r for r, _ in DEMO_REGIONS], i).alias(S.REGION),
        _pick([c for _, c in DEMO_REGIONS], i).alias(S.COUNTRY),
        _pick(DEMO_ITEM_TYPES, i).alias(S.ITEM_TYPE),
        _pick(DEMO_CHANNELS, i).alias(S.SALES_CHANNEL),
        _pick(DEMO_PRIORITIES, i).alias(S.ORDER_PRIORITY),
        order_date.cast(T.TimestampNTZType()).alias(S.ORDER_DATE),
        (F.lit(DEMO_ORDER_ID_BASE) + i).alias(S.ORDER_ID),
        ship_date.cast(T.TimestampNTZType()).alias(S.SHIP_DATE),
        units.alias(S.UNITS_SOLD),
        price.cast("double").alias(S.UNIT_PRICE),
        cost.cast("double").alias(S.UNIT_COST),
        revenue.alias(S.TOTAL_REVENUE),
        total_cost.alias(S.TOTAL_COST),
        F.round(revenue - total_cost, 2).cast(S.MONEY_TYPE).alias(S.TOTAL_PROFIT),
    )


def synthetic_sales(spark: SparkSession, n: int = DEMO_ROWS) -> DataFrame:
    """The demo table: ``n`` rows (360 by default) generated in parallel."""
    return synthetic_sales_from_index(spark.range(n), "id")


def empty_sales(spark: SparkSession) -> DataFrame:
    """An empty sales table with the full typed schema."""
    return spark.createDataFrame([], S.SALES_SCHEMA)


def sales_or_demo(spark: SparkSession, csv_path: str, demo: DataFrame | None = None) -> tuple[str, DataFrame]:
    """``("csv", rows)`` of the sales CSV if there is one, else ``("demo", rows)``.

    The choice is returned with the rows, so that no caller takes demo rows for
    sales.  ``demo`` may give the rows to fall back to.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(csv_path)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return "csv", read_sales_csv(spark, csv_path)
    return "demo", synthetic_sales(spark) if demo is None else demo
