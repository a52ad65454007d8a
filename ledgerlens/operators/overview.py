"""Dashboard bundles: KPI rows, preview tables and the overview sections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schema as S
from ledgerlens.functions.calendar import day_label, event_time, month_label, year_of
from ledgerlens.functions.money import (
    margin_total_pct,
    margin_unit_pct,
    mean_margin,
    money_sum,
)
from ledgerlens.operators import aggregates as A
from ledgerlens.operators.filters import optional_filter
from ledgerlens.operators.ranking import top_n


def as_output(df: DataFrame) -> DataFrame:
    """Exact decimal columns as DOUBLE for presentation and exchange."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def with_backend_columns(sales: DataFrame) -> DataFrame:
    """Event time, year, ``yyyy-MM`` month and total-form margin (backend enrichment)."""
    return sales.withColumns(
        {
            S.EVENT_TIME: event_time(S.ORDER_DATE, S.ORDER_ID),
            S.YEAR: year_of(S.ORDER_DATE),
            S.MONTH: month_label(S.ORDER_DATE),
            S.MARGIN_PCT: margin_total_pct(S.TOTAL_PROFIT, S.TOTAL_REVENUE),
        }
    )


def kpis(sales: DataFrame) -> DataFrame:
    """Overview metrics in one aggregate: emptiness flag, revenue, profit,
    mean of the per-row margins (total form) and distinct orders.

    A frame of orders (with the margin sums) or a summary gives the same metrics
    as its lines.
    """
    if S.MARGIN_SUM in sales.columns:
        margin = F.try_divide(F.sum(S.MARGIN_SUM).cast("double"), F.sum(S.MARGIN_LINES))
        orders = (
            F.coalesce(F.sum(S.ORDERS), F.lit(0)) if S.ORDERS in sales.columns else F.count(S.ORDER_ID)
        )
    else:
        margin = mean_margin(margin_total_pct(S.TOTAL_PROFIT, S.TOTAL_REVENUE))
        orders = F.count_distinct(S.ORDER_ID)
    return sales.agg(
        (F.count(F.lit(1)) == 0).alias("empty"),
        money_sum(S.TOTAL_REVENUE).alias(S.TOTAL_REVENUE),
        money_sum(S.TOTAL_PROFIT).alias(S.TOTAL_PROFIT),
        margin.alias("avg_margin"),
        orders.alias("order_count"),
    )


def record_kpis(sales: DataFrame) -> DataFrame:
    """Pipeline-page metrics: rows, revenue, profit, mean unit-form margin."""
    margin = margin_unit_pct(S.UNIT_PRICE, S.UNIT_COST)
    return sales.agg(
        F.count(F.lit(1)).alias("rows"),
        money_sum(S.TOTAL_REVENUE).alias(S.TOTAL_REVENUE),
        money_sum(S.TOTAL_PROFIT).alias(S.TOTAL_PROFIT),
        mean_margin(margin).alias("avg_margin"),
    )


def preview_latest(sales: DataFrame, n: int = 200) -> DataFrame:
    """Latest ``n`` lines by order date (text ``yyyy-MM-dd``), ties by row key."""
    keys = S.row_key_of(sales.columns)
    latest = top_n(sales, n, [F.desc(S.ORDER_DATE)] + [F.asc(k) for k in keys])
    out = latest.select(
        day_label(S.ORDER_DATE).alias(S.ORDER_DATE),
        S.REGION,
        S.COUNTRY,
        S.ITEM_TYPE,
        S.SALES_CHANNEL,
        S.UNITS_SOLD,
        S.TOTAL_REVENUE,
        S.TOTAL_PROFIT,
        margin_total_pct(S.TOTAL_PROFIT, S.TOTAL_REVENUE).alias(S.MARGIN_PCT),
    )
    return as_output(out)


def preview_first(sales: DataFrame, n: int = 100) -> DataFrame:
    """First ``n`` lines in a defined order (order date, then row key)."""
    keys = S.row_key_of(sales.columns)
    return as_output(top_n(sales, n, [F.asc(S.ORDER_DATE)] + [F.asc(k) for k in keys]))


def overview_of_orders(
    orders: DataFrame,
    years: Sequence[int] | None = None,
    regions: Sequence[str] | None = None,
    channels: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """The overview's sections that need no line detail, from one row per order."""
    filtered = optional_filter(orders, years, regions, channels)
    return {
        "metrics": kpis(filtered),
        "monthly": A.monthly_trend(filtered),
        "by_region": A.profit_by_region(filtered),
    }


def overview(
    sales: DataFrame,
    years: Sequence[int] | None = None,
    regions: Sequence[str] | None = None,
    channels: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """All sections of the overview request over one filtered frame.

    The sections are independent lazy plans; a caller that executes several of
    them should ``persist()`` ``sales`` (or the filtered frame) first.
    """
    filtered = optional_filter(sales, years, regions, channels)
    return {
        "metrics": kpis(filtered),
        "monthly": A.monthly_trend(filtered),
        "top_items": A.top_by_profit(filtered, S.ITEM_TYPE, 10),
        "by_region": A.profit_by_region(filtered),
        "preview": preview_latest(filtered, 200),
    }
