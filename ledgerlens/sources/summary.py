"""The sales fact summed up once, for questions that need no line or order.

One row per month, region, country, channel and item type, with exact sums that
add up over any of them: dashboards answer from it without touching lines or
orders again.  Its size is bounded by the domains of its columns, not by the
lines.  The month is kept in the order date column (its first day), so the
operators take a summary like lines or orders, year selections included.

``orders`` counts each order in one of its item types, so it adds up to the
distinct orders wherever all item types are taken together, and says nothing
about a single item type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schema as S
from ledgerlens.functions.calendar import month_label, year_of
from ledgerlens.functions.money import money_sum, units_sum
from ledgerlens.session import scratch_path
from ledgerlens.sources.star import order_item_totals

_SUM = T.DecimalType(38, 4)
SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField(S.ORDER_DATE, T.TimestampNTZType(), True),
        *[T.StructField(c, T.StringType(), True) for c in (S.REGION, S.COUNTRY, S.SALES_CHANNEL, S.ITEM_TYPE)],
        *[T.StructField(c, _SUM, True) for c in (S.TOTAL_REVENUE, S.TOTAL_PROFIT, S.UNITS_SOLD, S.MARGIN_SUM)],
        *[T.StructField(c, T.LongType(), True) for c in (S.LINES, S.MARGIN_LINES, S.ORDERS)],
    ]
)
_KEYS = SUMMARY_SCHEMA.names[:5]
_MEASURES = SUMMARY_SCHEMA.names[5:]


def sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary's rows from one pass over the star.

    Lines are reduced per order and item type before the order join; the flag
    of an order's first item type is found on the join's own partitioning.
    """
    nth = F.row_number().over(Window.partitionBy(S.ORDER_ID).orderBy(S.ITEM_TYPE))
    rows = order_item_totals(spark, sf_dir).withColumns(
        {
            S.ORDERS: ((nth == 1) & F.col(S.ORDER_ID).isNotNull()).cast("long"),
            S.ORDER_DATE: F.trunc(S.ORDER_DATE, "month").cast(T.TimestampNTZType()),
        }
    )
    sums = rows.groupBy(*_KEYS).agg(*[F.sum(m).alias(m) for m in _MEASURES])
    return sums.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SUMMARY_SCHEMA])


def write_summary(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Write the summary once and return a reader over it."""
    path = path or scratch_path(spark, "sales_summary")
    sales_summary(spark, sf_dir).write.mode("overwrite").parquet(path)
    return read_summary(spark, path)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUMMARY_SCHEMA).parquet(path)


def sales_cube(summary: DataFrame) -> DataFrame:
    """Revenue, profit, units, mean margin and orders by region, country, item
    type, month and year, and in all: grouping sets over the summary.

    ``level`` names the grouping; the columns it doesn't group by are null.
    Orders of an item type are null (see the module).
    """
    rows = summary.withColumns({S.MONTH: month_label(S.ORDER_DATE), S.YEAR: year_of(S.ORDER_DATE)})
    keys = [S.REGION, S.COUNTRY, S.ITEM_TYPE, S.MONTH, S.YEAR]
    sets = {
        "region": [S.REGION],
        "country": [S.REGION, S.COUNTRY],
        "item_type": [S.ITEM_TYPE],
        "month": [S.MONTH],
        "year": [S.YEAR],
        "all": [],
    }
    ids = {name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in own) for name, own in sets.items()}
    level = F.coalesce(*[F.when(F.col("_set") == i, F.lit(name)) for name, i in ids.items()])
    cube = rows.groupingSets([[F.col(c) for c in own] for own in sets.values()], *keys).agg(
        F.grouping_id().alias("_set"),
        money_sum(S.TOTAL_REVENUE).alias(S.TOTAL_REVENUE),
        money_sum(S.TOTAL_PROFIT).alias(S.TOTAL_PROFIT),
        units_sum(S.UNITS_SOLD).alias(S.UNITS_SOLD),
        F.try_divide(F.sum(S.MARGIN_SUM).cast("double"), F.sum(S.MARGIN_LINES)).alias("avg_margin"),
        F.sum(S.LINES).alias(S.LINES),
        F.sum(S.ORDERS).alias("order_count"),
    )
    orders = F.when(F.col("level") != "item_type", F.col("order_count"))
    return cube.withColumn("level", level).drop("_set").withColumn("order_count", orders)
