"""Sales orders as a stream: CSV landing -> typed silver / quarantine -> hourly
KPIs and the region x item type serving table.

Sales rows land as CSV text (the layout of the sales CSV, header names
included).  The stream reuses the batch operators: the same lenient
parsing and numeric coercion as ``sources.cleaning``, the same event-time
enrichment as ``functions.calendar.event_time``.  Rows whose order date cannot
be parsed go to the quarantine instead of being dropped silently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schema as S
from ledgerlens.functions.calendar import event_time
from ledgerlens.operators.ranking import top_n
from ledgerlens.sources.cleaning import coerce_numeric, lenient_timestamp, trim_text
from ledgerlens.streaming.pipeline import (
    WINDOW_START,
    StreamPaths,
    append_sink,
    first_of_each,
    read_changes,
    with_window_end,
    write_changes,
)

_FROM_CSV = dict(zip(S.CSV_HEADER, S.SALES_COLUMNS))

SILVER_SALES_SCHEMA = T.StructType(
    [f for f in S.SALES_SCHEMA.fields]
    + [T.StructField(S.EVENT_TIME, T.TimestampNTZType(), True), T.StructField("event_year", T.IntegerType(), True)]
)
QUARANTINE_SALES_SCHEMA = T.StructType(
    [
        T.StructField(S.ORDER_ID, T.LongType(), True),
        T.StructField("order_date_text", T.StringType(), True),
        T.StructField("reason", T.StringType(), True),
    ]
)


def sales_text_stream(spark: SparkSession, landing: str) -> DataFrame:
    raw = spark.readStream.schema(S.CSV_TEXT_SCHEMA).option("header", True).csv(landing)
    return raw.select(*[F.col(f"`{old}`").alias(new) for old, new in _FROM_CSV.items()])


def _typed(raw: DataFrame) -> DataFrame:
    typed = raw.withColumns(
        {
            "order_date_text": F.col(S.ORDER_DATE),
            S.ORDER_DATE: lenient_timestamp(S.ORDER_DATE),
            S.SHIP_DATE: lenient_timestamp(S.SHIP_DATE),
        }
    )
    return coerce_numeric(trim_text(typed))


def _reason() -> Column:
    return F.when(F.col(S.ORDER_DATE).isNull(), F.lit("unparsable order date")).when(
        F.col(S.ORDER_ID).isNull(), F.lit("missing order id")
    )


def sales_silver_rows(raw: DataFrame) -> DataFrame:
    typed = _typed(raw)
    valid = typed.where(_reason().isNull())
    timed = valid.withColumn(S.EVENT_TIME, event_time(S.ORDER_DATE, S.ORDER_ID))
    return timed.withColumn("event_year", F.year(S.EVENT_TIME)).select(*SILVER_SALES_SCHEMA.names)


def sales_quarantine_rows(raw: DataFrame) -> DataFrame:
    typed = _typed(raw)
    return typed.where(_reason().isNotNull()).select(
        S.ORDER_ID, "order_date_text", _reason().alias("reason")
    )


def write_sales_silver(
    spark: SparkSession, landing: str, paths: StreamPaths, row_key: tuple[str, ...] = ()
) -> str:
    """Silver, partitioned by event year (sales days are many and small).

    ``row_key`` names the columns that make a sales row unique, such as the
    order id of a one-line-per-order file: rows delivered again are then
    dropped.  A sales file of order lines has no such key, and keeps all rows.
    """
    rows = sales_silver_rows(sales_text_stream(spark, landing))
    if row_key:
        rows = first_of_each(rows, list(row_key), "event_year")
    return append_sink(rows, paths, "sales_silver", "event_year")


def write_sales_quarantine(spark: SparkSession, landing: str, paths: StreamPaths) -> str:
    return append_sink(sales_quarantine_rows(sales_text_stream(spark, landing)), paths, "sales_quarantine")


def _silver_stream(spark: SparkSession, silver: str) -> DataFrame:
    return spark.readStream.schema(SILVER_SALES_SCHEMA).parquet(silver)


def _sums_schema(keys: list[T.StructField], measures: dict[str, T.DataType]) -> T.StructType:
    return T.StructType(keys + [T.StructField(m, dtype, True) for m, dtype in measures.items()])


SALES_HOURLY_MEASURES: dict[str, T.DataType] = {
    "lines": T.LongType(),
    S.TOTAL_REVENUE: T.DecimalType(38, 4),
    S.UNITS_SOLD: T.DecimalType(38, 2),
}
SALES_HOURLY_SCHEMA = _sums_schema([WINDOW_START], SALES_HOURLY_MEASURES)


def sales_hourly_sums(silver: DataFrame) -> DataFrame:
    """Lines, exact revenue and units by event-time hour (its start)."""
    sums = silver.groupBy(F.window(S.EVENT_TIME, "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(S.TOTAL_REVENUE).alias(S.TOTAL_REVENUE),
        F.sum(S.UNITS_SOLD).alias(S.UNITS_SOLD),
    )
    cast = [F.col(m).cast(t).alias(m) for m, t in SALES_HOURLY_MEASURES.items()]
    return sums.select(F.col("w.start").alias("window_start"), *cast)


def write_sales_hourly(spark: SparkSession, silver: str, paths: StreamPaths) -> str:
    """Hourly windows kept by a stateful stream; late rows add to their window."""
    return write_changes(sales_hourly_sums(_silver_stream(spark, silver)), paths, "sales_hourly", SALES_HOURLY_SCHEMA)


def read_sales_hourly(spark: SparkSession, hourly: str) -> DataFrame:
    latest = read_changes(spark, hourly, SALES_HOURLY_SCHEMA, ["window_start"])
    return with_window_end(latest).withColumns(
        {m: F.col(m).cast("double") for m in (S.TOTAL_REVENUE, S.UNITS_SOLD)}
    )


# ---------------------------------------------------------------- serving table

SALES_SERVING_KEYS = [S.REGION, S.ITEM_TYPE]
SALES_SERVING_MEASURES: dict[str, T.DataType] = {
    S.TOTAL_REVENUE: T.DecimalType(38, 4),
    S.TOTAL_PROFIT: T.DecimalType(38, 4),
    S.UNITS_SOLD: T.DecimalType(38, 2),
}
SALES_SERVING_SCHEMA = _sums_schema(
    [T.StructField(k, T.StringType(), True) for k in SALES_SERVING_KEYS], SALES_SERVING_MEASURES
)


def sales_serving_sums(silver: DataFrame) -> DataFrame:
    """Exact sums per (region, item type); the partial sums run map-side, so a
    hot key reaches the state as a few rows."""
    sums = silver.groupBy(*SALES_SERVING_KEYS).agg(*[F.sum(m).alias(m) for m in SALES_SERVING_MEASURES])
    return sums.select(*SALES_SERVING_KEYS, *[F.col(m).cast(t).alias(m) for m, t in SALES_SERVING_MEASURES.items()])


def write_sales_serving(spark: SparkSession, silver: str, paths: StreamPaths) -> str:
    """The streamed serving table: sums per region and item type (``pipeline.write_changes``)."""
    return write_changes(
        sales_serving_sums(_silver_stream(spark, silver)), paths, "sales_serving", SALES_SERVING_SCHEMA
    )


def read_sales_serving(spark: SparkSession, path: str, n: int = 20) -> DataFrame:
    """Top ``n`` (region, item type) rows by profit from the serving table."""
    latest = read_changes(spark, path, SALES_SERVING_SCHEMA, SALES_SERVING_KEYS)
    out = latest.select(
        *SALES_SERVING_KEYS, *[F.col(m).cast("double").alias(m) for m in SALES_SERVING_MEASURES]
    )
    return top_n(out, n, [F.desc(S.TOTAL_PROFIT), F.asc(S.REGION), F.asc(S.ITEM_TYPE)])
