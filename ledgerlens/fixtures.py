"""Producers for tests and example queries: the driver tables as raw text with defects.

No operator reads from here.  Every defect depends on the content of its record
only, so a rendering is the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.sources.cleaning import SALES_DATE_FORMAT
from ledgerlens.sources.tables import read_table

TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_TO_CSV = dict(zip(S.SALES_COLUMNS, S.CSV_HEADER))


def events_as_text(events: DataFrame) -> DataFrame:
    """Events as a text producer sends them, with realistic defects.

    ``signup`` types arrive padded and upper-cased (silver normalises them),
    ``error`` events carry the value ``n/a`` and records whose ``k`` is 95 or
    more are sent as ``k=<n>`` instead of JSON props.  The defects depend on
    the record content only, so the rendering is deterministic.
    """
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format("ts", TS_TEXT_FORMAT).alias("ts"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("event_type") == "signup", F.lit(" SIGNUP "))
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.when(F.col("event_type") == "error", F.lit("n/a"))
        .otherwise(F.col("value").cast("string"))
        .alias("value"),
        F.when(
            F.get_json_object("props", "$.k").try_cast("int") >= 95,
            F.concat(F.lit("k="), F.get_json_object("props", "$.k")),
        )
        .otherwise(F.col("props"))
        .alias("props"),
        F.to_date("ts").alias("event_date"),
    )


def render_sales_csv(sales: DataFrame) -> DataFrame:
    """Sales rows as a CSV producer writes them (all text, CSV header names).

    Low-priority orders arrive with day and month swapped - a common export
    bug: such a date parses to the wrong day when the day is at most 12 and
    fails (quarantine) otherwise.  The defect depends on row content only.
    """
    date_text = F.when(
        F.col(S.ORDER_PRIORITY) == "5-LOW", F.date_format(S.ORDER_DATE, "d/M/yyyy")
    ).otherwise(F.date_format(S.ORDER_DATE, SALES_DATE_FORMAT))
    cols = []
    for name in S.SALES_COLUMNS:
        if name == S.ORDER_DATE:
            value = date_text
        elif name == S.SHIP_DATE:
            value = F.date_format(S.SHIP_DATE, SALES_DATE_FORMAT)
        else:
            value = F.col(name).cast("string")
        cols.append(value.alias(_TO_CSV[name]))
    return sales.select(*cols)


def write_landing(sales: DataFrame, path: str) -> str:
    """Land sales rows as CSV files (the producer side, a batch write)."""
    render_sales_csv(sales).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_defective_landing(sales: DataFrame, path: str) -> list[str]:
    """Land sales rows as CSV folders with defects of every kind; returns the folders.

    Beside the swapped dates of ``render_sales_csv``: urgent orders carry a
    currency before the unit price and lack their order date in every seventh
    order; every eleventh order comes with a surplus field, every thirteenth
    without its last two.
    """
    text = render_sales_csv(sales)
    urgent = F.col("Order Priority") == "1-URGENT"
    order = F.col("Order ID").cast("long")
    text = text.withColumns(
        {
            "Unit Price": F.when(urgent, F.concat(F.lit("USD "), "Unit Price")).otherwise(F.col("Unit Price")),
            "Order Date": F.when(urgent & (order % 7 == 0), F.lit("")).otherwise(F.col("Order Date")),
        }
    )
    surplus, short = order % 11 == 0, (order % 11 != 0) & (order % 13 == 0)
    parts = {
        "plain": text.where(~surplus & ~short),
        "surplus": text.where(surplus).withColumn("Remark", F.lit("x")),
        "short": text.where(short).drop(*S.CSV_HEADER[-2:]),
    }
    for name, rows in parts.items():
        rows.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
    return [f"{path}/{name}" for name in parts]


def orders_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table rendered as raw text with realistic defects.

    Final orders carry day/month swapped dates (only valid when the day is at
    most 12), pending orders an empty date, urgent orders a currency prefix on
    the price.  Everything else is well formed ``M/d/yyyy`` and plain numbers.
    """
    o = read_table(spark, sf_dir, "orders")
    date_text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "d/M/yyyy"))
        .when(F.col("o_orderstatus") == "P", F.lit(""))
        .otherwise(F.date_format("o_orderdate", SALES_DATE_FORMAT))
    )
    price_text = F.when(
        F.col("o_orderpriority") == "1-URGENT",
        F.concat(F.lit("USD "), F.col("o_totalprice").cast("string")),
    ).otherwise(F.col("o_totalprice").cast("string"))
    return o.select(
        F.col("o_orderkey").cast("string").alias(S.ORDER_ID),
        date_text.alias(S.ORDER_DATE),
        price_text.alias("total_price"),
        F.col("o_orderpriority").alias(S.ORDER_PRIORITY),
    )
