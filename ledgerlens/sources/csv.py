"""Sales CSV source: fixed text schema, no inference pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schema as S
from ledgerlens.sources.cleaning import NUMERIC_TYPES, SALES_DATE_FORMAT, clean_sales_text, lenient_timestamp

_RENAMES = dict(zip(S.CSV_HEADER, S.SALES_COLUMNS))


def read_sales_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row, every column as text, renamed to snake_case."""
    raw = spark.read.schema(S.CSV_TEXT_SCHEMA).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return raw.select(*[F.col(f"`{old}`").alias(new) for old, new in _RENAMES.items()])


CORRUPT = "corrupt_record"
_DATES = (S.ORDER_DATE, S.SHIP_DATE)


def csv_rejects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """What the lenient scan of a sales CSV turns into null or drops, and why.

    One row per rejected value: ``order_id`` (as text), ``column_name``, the
    ``value`` as delivered and the ``reason``.  A record with too many or too
    few fields is one row without a column: its ``value`` is the raw record.  A
    blank order date drops its row and is a reject; other blank values are
    plain nulls.
    """
    schema = T.StructType([*S.CSV_TEXT_SCHEMA.fields, T.StructField(CORRUPT, T.StringType(), True)])
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    # Every field is parsed, else a record's surplus would go unseen.
    raw = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(path)
    rows = raw.select(*[F.col(f"`{old}`").alias(new) for old, new in _RENAMES.items()], CORRUPT)

    def reject(name: str, reason: str) -> Column:
        return F.struct(F.lit(name).alias("column_name"), F.col(name).alias("value"), F.lit(reason).alias("reason"))

    def blank(name: str) -> Column:
        return F.coalesce(F.trim(F.col(name)) == "", F.lit(True))

    found = [F.when(blank(S.ORDER_DATE), reject(S.ORDER_DATE, "missing order date"))]
    for name in _DATES:
        found.append(F.when(~blank(name) & lenient_timestamp(name).isNull(), reject(name, "unparsable date")))
    for name, kind in NUMERIC_TYPES.items():
        parsed = F.trim(F.col(name)).try_cast(kind)
        found.append(F.when(~blank(name) & parsed.isNull(), reject(name, "not a number")))
    record = F.struct(
        F.lit(None).cast("string").alias("column_name"),
        F.col(CORRUPT).alias("value"),
        F.lit("wrong number of fields").alias("reason"),
    )
    each = F.when(F.col(CORRUPT).isNotNull(), F.array(record)).otherwise(F.array_compact(F.array(*found)))
    return rows.select(S.ORDER_ID, F.explode(each).alias("r")).select(S.ORDER_ID, "r.*")


def write_sales_csv(sales: DataFrame, path: str) -> str:
    """Write typed sales rows as a sales CSV (header names, ``M/d/yyyy`` dates)."""
    names = dict(zip(S.SALES_COLUMNS, S.CSV_HEADER))
    dates = (S.ORDER_DATE, S.SHIP_DATE)
    text = [
        (F.date_format(c, SALES_DATE_FORMAT) if c in dates else F.col(c).cast("string")).alias(names[c])
        for c in S.SALES_COLUMNS
    ]
    sales.select(*text).write.option("header", True).csv(path)
    return path


def read_sales_csv(spark: SparkSession, path: str) -> DataFrame:
    """Typed sales rows from a sales CSV (lenient cleaning, see ``clean_sales_text``)."""
    return clean_sales_text(read_sales_text(spark, path))
