"""Grouped business questions over the sales fact.

Every function takes the sales fact (or a filtered part of it) and returns a
lazy DataFrame.  Aggregations are hash aggregates with a map-side partial step,
so a group that holds a third of all rows is pre-reduced in every task before
the shuffle.  Results that are "the best X" are one-row DataFrames built with
``orderBy().limit()``, never a value pulled to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schema as S
from ledgerlens.functions.calendar import month_label, month_of, year_of
from ledgerlens.functions.money import (
    exact_mean,
    margin_unit_pct,
    mean_margin,
    money_sum,
    units_sum,
)
from ledgerlens.operators.filters import weekend_in_region
from ledgerlens.operators.joins import checked_broadcast
from ledgerlens.operators.ranking import top_n, top_n_per_group

UNITS_MEAN_TYPE = T.DecimalType(30, 2)


def sum_by(df: DataFrame, keys: list[str], measure: str, alias: str | None = None) -> DataFrame:
    """Exact sum of a money column per key (double result)."""
    return df.groupBy(*keys).agg(money_sum(measure).alias(alias or measure))


def profit_by(df: DataFrame, keys: list[str]) -> DataFrame:
    return sum_by(df, keys, S.TOTAL_PROFIT)


def profit_by_region(sales: DataFrame) -> DataFrame:
    """Total profit per region, best first."""
    return profit_by(sales, [S.REGION]).orderBy(F.desc(S.TOTAL_PROFIT), S.REGION)


def best_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """Arg-max as a one-row frame; on a tie the smallest key wins."""
    return top_n(df, 1, [F.desc(value), F.asc(key)])


def top_profit_region(sales: DataFrame) -> DataFrame:
    return best_by(profit_by(sales, [S.REGION]), S.REGION, S.TOTAL_PROFIT)


def top_country_in_top_region(sales: DataFrame) -> DataFrame:
    """Best region by profit, then the best country inside it — one DAG.

    The fact is aggregated once to (region, country).  The region total is a
    window sum over that small aggregate, and one ordering - region total,
    region, country total, country - puts the answer first.  There is no
    second pass over the fact and no semi-join for the optimizer to push back
    into it.  Sums stay decimal until the end, so the re-aggregation is exact.
    """
    by_rc = sales.groupBy(S.REGION, S.COUNTRY).agg(F.sum(S.TOTAL_PROFIT).alias("_p"))
    with_total = by_rc.withColumn("_rp", F.sum("_p").over(Window.partitionBy(S.REGION)))
    best = top_n(
        with_total, 1, [F.desc("_rp"), F.asc(S.REGION), F.desc("_p"), F.asc(S.COUNTRY)]
    )
    return best.select(
        S.REGION,
        F.col("_rp").cast("double").alias("region_profit"),
        S.COUNTRY,
        F.col("_p").cast("double").alias(S.TOTAL_PROFIT),
    )


def orders_per_window(
    df: DataFrame,
    time_col: str = S.ORDER_DATE,
    id_col: str = S.ORDER_ID,
    duration: str = "72 hours",
    slide: str | None = None,
    count_alias: str = "count_order_id",
    rows_alias: str | None = None,
) -> DataFrame:
    """Orders per epoch-aligned event-time window (tumbling unless ``slide``).

    ``count(id)`` skips null ids, as the question counts order ids;
    ``rows_alias`` adds the count of rows.  Sliding windows are summed from
    the counts per slide, so no order is expanded into several windows.
    """
    counted = [count_alias] + ([rows_alias] if rows_alias else [])
    win = F.window(time_col, slide or duration)
    counts = df.groupBy(win.alias("w")).agg(
        F.count(id_col).alias(count_alias), *([F.count(F.lit(1)).alias(rows_alias)] if rows_alias else [])
    )
    if slide:
        counts = (
            counts.select(F.col("w.start").alias("at"), *counted)
            .groupBy(F.window("at", duration, slide).alias("w"))
            .agg(*[F.sum(c).alias(c) for c in counted])
        )
    return counts.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *counted
    )


def max_orders_per_window(df: DataFrame, **kwargs) -> DataFrame:
    counts = orders_per_window(df, **kwargs)
    return counts.agg(F.max("count_order_id").alias("max_orders"))


def avg_units_by_month(sales: DataFrame) -> DataFrame:
    """Mean units per order line by month of year (years pooled), best first.

    A frame of orders (with ``lines``) gives the same means as its lines.
    """
    mean = (
        F.try_divide(units_sum(S.UNITS_SOLD), F.sum(S.LINES))
        if S.LINES in sales.columns
        else exact_mean(S.UNITS_SOLD, UNITS_MEAN_TYPE)
    )
    return (
        sales.groupBy(month_of(S.ORDER_DATE).alias(S.MONTH))
        .agg(mean.alias("avg_units_sold"))
        .orderBy(F.desc("avg_units_sold"), S.MONTH)
    )


def order_margin_pct(sales: DataFrame) -> DataFrame:
    """Per-line margin from unit prices, rounded to a whole percent."""
    margin = sales.withColumnsRenamed({S.UNIT_PRICE: "sp", S.UNIT_COST: "cp"}).select(
        S.ORDER_ID, "sp", "cp"
    )
    return margin.withColumn("percentage", margin_unit_pct("sp", "cp", digits=0))


def margin_extremes(sales: DataFrame) -> DataFrame:
    """Lowest and highest rounded margin: one aggregate, no sort."""
    m = order_margin_pct(sales)
    return m.agg(
        F.min("percentage").alias("lowest_margin_pct"),
        F.max("percentage").alias("highest_margin_pct"),
    )


def top3_orders_per_item(sales: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most profitable lines of every item type (ties by row key)."""
    order = [F.desc(S.TOTAL_PROFIT)] + [F.asc(k) for k in S.row_key_of(sales.columns)]
    return top_n_per_group(sales, [S.ITEM_TYPE], n, order)


#: Parts of an item type's lines whose best profits bound those of its first lines.
PROFIT_PARTS = 1024


def of_high_profit(sales: DataFrame, n: int, types: int) -> DataFrame:
    """Lines that may be among the ``n`` most profitable of one of the ``types`` item types: few, and all of those.

    The lines of a type are parted by their order, and its bound is the ``n``-th
    best of the parts' best profits: at least ``n`` lines reach it.  A type
    with fewer parts has no bound and keeps all.  A hash aggregate finds the
    bounds, so that no sort has to hold all lines.
    """
    part = F.pmod(F.xxhash64(S.ORDER_ID), F.lit(PROFIT_PARTS))
    best = sales.groupBy(S.ITEM_TYPE, part.alias("_part")).agg(F.max(S.TOTAL_PROFIT).alias("_bound"))
    best = best.where(F.col("_bound").isNotNull())
    rank = F.row_number().over(Window.partitionBy(S.ITEM_TYPE).orderBy(F.desc("_bound")))
    bounds = best.withColumn("_rank", rank).where(F.col("_rank") == n)
    bounds = checked_broadcast(bounds.select(F.col(S.ITEM_TYPE).alias("_type"), "_bound"), types)
    met = sales.join(bounds, F.col(S.ITEM_TYPE).eqNullSafe(F.col("_type")), "left")
    return met.where(F.col("_bound").isNull() | (F.col(S.TOTAL_PROFIT) >= F.col("_bound"))).select(*sales.columns)


def weekend_units_by_item(sales: DataFrame, region: str) -> DataFrame:
    """Units sold on weekends in one region per item type, most first."""
    return (
        weekend_in_region(sales, region)
        .groupBy(S.ITEM_TYPE)
        .agg(units_sum(S.UNITS_SOLD).alias("sum_units_sold"))
        .orderBy(F.desc("sum_units_sold"), S.ITEM_TYPE)
    )


def yearly_revenue(sales: DataFrame, alias: str = "yearly_revenue") -> DataFrame:
    return sales.groupBy(year_of(S.ORDER_DATE).alias(S.YEAR)).agg(
        money_sum(S.TOTAL_REVENUE).alias(alias)
    )


def _previous(col: str) -> Column:
    # The input is one row per year (tens of rows): an unpartitioned window over
    # it runs in one task by design.
    return F.lag(col, 1).over(Window.orderBy(S.YEAR))


def yoy_growth_label(sales: DataFrame) -> DataFrame:
    """Year, revenue and growth as text ``"<rounded int> %"`` (null first year)."""
    yearly = yearly_revenue(sales)
    prev = _previous("yearly_revenue")
    pct = F.try_divide(F.col("yearly_revenue") - prev, prev) * F.lit(100.0)
    label = F.concat(F.round(pct).cast("int").cast("string"), F.lit(" %"))
    return yearly.withColumn("yoy_growth", label).orderBy(S.YEAR)


def yoy_growth_pct(sales: DataFrame) -> DataFrame:
    """Year, revenue and unrounded percent change to the previous year."""
    yearly = yearly_revenue(sales, alias=S.TOTAL_REVENUE)
    prev = _previous(S.TOTAL_REVENUE)
    pct = (F.try_divide(F.col(S.TOTAL_REVENUE), prev) - F.lit(1.0)) * F.lit(100.0)
    return yearly.withColumn("yoy_growth_pct", pct).orderBy(S.YEAR)


def monthly_trend(sales: DataFrame) -> DataFrame:
    """Revenue and profit per calendar month ``yyyy-MM``, in time order."""
    return (
        sales.groupBy(month_label(S.ORDER_DATE).alias(S.MONTH))
        .agg(
            money_sum(S.TOTAL_REVENUE).alias(S.TOTAL_REVENUE),
            money_sum(S.TOTAL_PROFIT).alias(S.TOTAL_PROFIT),
        )
        .orderBy(S.MONTH)
    )


def top_by_profit(sales: DataFrame, key: str, n: int) -> DataFrame:
    return top_n(profit_by(sales, [key]), n, [F.desc(S.TOTAL_PROFIT), F.asc(key)])


def filter_options(sales: DataFrame) -> DataFrame:
    """Sorted distinct years, regions and channels as ``(kind, value)`` rows.

    One pass: the distinct (year, region, channel) triples are reduced map-side
    and only then unpivoted, instead of three separate scans of the fact.
    """
    triples = sales.select(
        year_of(S.ORDER_DATE).cast("string").alias("y"), S.REGION, S.SALES_CHANNEL
    ).distinct()
    long = triples.select(
        F.expr(
            "stack(3, 'year', y, 'region', region, 'channel', sales_channel) AS (kind, value)"
        )
    )
    return long.where(F.col("value").isNotNull()).distinct().orderBy("kind", "value")


def orders_by_priority(orders: DataFrame) -> DataFrame:
    """Order count and share per priority (declared in the reference README)."""
    counts = orders.groupBy(S.ORDER_PRIORITY).agg(F.count(F.lit(1)).alias("orders"))
    # One row per priority value: the global window over it is tiny.
    total = F.sum("orders").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("share", F.col("orders") / total).orderBy(S.ORDER_PRIORITY)


def margin_by_item(sales: DataFrame) -> DataFrame:
    """Average unit margin and line count per item type, highest first."""
    m = sales.select(S.ITEM_TYPE, margin_unit_pct(S.UNIT_PRICE, S.UNIT_COST).alias(S.MARGIN_PCT))
    return (
        m.groupBy(S.ITEM_TYPE)
        .agg(mean_margin(S.MARGIN_PCT).alias("avg_margin_pct"), F.count(F.lit(1)).alias("lines"))
        .orderBy(F.desc("avg_margin_pct"), S.ITEM_TYPE)
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))
