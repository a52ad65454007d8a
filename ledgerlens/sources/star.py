"""The sales fact as a star-schema view over the driver tables.

One row per line item.  Business columns map onto the TPC-H-style tables:

    region / country   r_name / n_name of the customer's nation
    item_type          p_type
    sales_channel      c_mktsegment
    order_priority     o_orderpriority
    order_date         o_orderdate          ship_date   l_shipdate
    order_id           l_orderkey           units_sold  l_quantity
    unit_price         l_extendedprice / l_quantity
    unit_cost          p_retailprice
    total_revenue      extendedprice * (1 - discount), exact decimal
    total_cost         quantity * retailprice, exact decimal
    total_profit       revenue - cost

A line with a dangling key is left out of every answer alike.  A side that gives
columns is joined; one that is asked for existence only is a semi-join on its
keys.  Catalyst prunes each side to the join keys and the columns in use.
Whether a side is broadcast is left to Spark's
own size check (file sizes when planning, shuffle sizes at run time); beyond it
a sort-merge join is planned and AQE splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.functions.money import MARGIN_TYPE, exact, hundredths, margin_total_pct
from ledgerlens.sources.tables import read_table


# Whole hundredths of a line's quantity and ten-thousandths of its revenue:
# money is computed in integers and becomes a decimal once, or after a first sum.
_QUANTITY, _REVENUE, _COST = "_quantity", "_revenue", "_cost"


def _money(units: Column) -> Column:
    return exact(units, 4, S.MONEY_TYPE)


def geo_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias(S.COUNTRY), F.col("r_name").alias(S.REGION)
    )


def customer_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """custkey -> sales channel, country, region."""
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias(S.SALES_CHANNEL), "c_nationkey"
    )
    geo = geo_dimension(spark, sf_dir)
    return customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey")).drop(
        "n_nationkey", "c_nationkey"
    )


def order_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orderkey -> customer key, order date, priority."""
    return read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate").alias(S.ORDER_DATE),
        F.col("o_orderpriority").alias(S.ORDER_PRIORITY),
    )


def order_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orderkey -> order date, priority and customer attributes."""
    orders = order_columns(spark, sf_dir)
    customer = customer_dimension(spark, sf_dir)
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey", "o_custkey")


def _lines_as_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias(S.ORDER_ID),
        F.col("l_linenumber").alias(S.LINE_NUMBER),
        F.col("l_partkey").alias(S.PART_KEY),
        F.col("l_suppkey").alias(S.SUPP_KEY),
        F.col("l_extendedprice").alias(S.EXT_PRICE),
        F.col("l_shipdate").alias(S.SHIP_DATE),
        "l_quantity",
        "l_discount",
    )


def _with_line_columns(lines: DataFrame) -> DataFrame:
    others = [c for c in lines.columns if c not in ("l_quantity", "l_discount")]
    return lines.select(
        *others,
        exact(hundredths("l_quantity"), 2, S.UNITS_TYPE).alias(S.UNITS_SOLD),
        F.try_divide(F.col(S.EXT_PRICE), F.col("l_quantity")).alias(S.UNIT_PRICE),
        hundredths("l_quantity").alias(_QUANTITY),
        (hundredths(S.EXT_PRICE) * (F.lit(100) - hundredths("l_discount"))).alias(_REVENUE),
    ).withColumn(S.TOTAL_REVENUE, _money(F.col(_REVENUE)))


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-level sales columns straight from ``lineitem``."""
    return _with_line_columns(_lines_as_read(spark, sf_dir))


def valid_orders(spark: SparkSession, sf_dir: str, among: DataFrame | None = None) -> DataFrame:
    """Orders whose customer, nation and region exist: ``o_orderkey, o_orderdate``.

    ``among``: only the orders of these few lines; the others meet no customer.
    """
    regions = read_table(spark, sf_dir, "region").select("r_regionkey")
    nations = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    nations = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    customers = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if among is not None:
        orders = orders.join(among, F.col("o_orderkey") == F.col(S.ORDER_ID), "left_semi")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left_semi").drop("o_custkey")


def of_valid_orders(lines: DataFrame, spark: SparkSession, sf_dir: str, among: DataFrame | None = None) -> DataFrame:
    """Lines whose order exists and has a known customer (no column of it is needed)."""
    orders = valid_orders(spark, sf_dir, among).select("o_orderkey")
    return lines.join(orders, F.col(S.ORDER_ID) == F.col("o_orderkey"), "left_semi")


def of_known_parts(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose part exists (no column of it is needed)."""
    parts = read_table(spark, sf_dir, "part").select("p_partkey")
    return lines.join(parts, F.col(S.PART_KEY) == F.col("p_partkey"), "left_semi")


def priced_lines(spark: SparkSession, sf_dir: str, late: bool = False) -> DataFrame:
    """Lines with the item type, unit cost, total cost and profit of their part.

    ``late``: a line's own columns are computed above the part join, which then
    moves the columns as read; these are fewer if nearly all are wanted.
    """
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_type").alias(S.ITEM_TYPE), F.col("p_retailprice").alias(S.UNIT_COST)
    )
    at = F.col(S.PART_KEY) == F.col("p_partkey")
    if late:
        lines = _with_line_columns(_lines_as_read(spark, sf_dir).join(part, at))
    else:
        lines = line_items(spark, sf_dir).join(part, at)
    return (
        lines.drop("p_partkey")
        .withColumn(_COST, F.col(_QUANTITY) * hundredths(S.UNIT_COST))
        .withColumns(
            {
                S.TOTAL_COST: _money(F.col(_COST)),
                S.TOTAL_PROFIT: _money(F.col(_REVENUE) - F.col(_COST)),
            }
        )
    )


def line_sums() -> list[Column]:
    """Revenue, profit, units, lines and row margins (total form) of a few lines, from ``priced_lines``.

    Integer sums, made decimals after: for groups of so many lines that a long
    holds them, such as an order's.
    """
    profit = F.col(_REVENUE) - F.col(_COST)
    margin = margin_total_pct(profit / F.lit(10000.0), F.col(_REVENUE) / F.lit(10000.0))
    return [
        _money(F.sum(_REVENUE)).alias(S.TOTAL_REVENUE),
        _money(F.sum(profit)).alias(S.TOTAL_PROFIT),
        exact(F.sum(_QUANTITY), 2, S.UNITS_TYPE).alias(S.UNITS_SOLD),
        F.count(F.lit(1)).alias(S.LINES),
        exact(F.sum(hundredths(margin)), 2, MARGIN_TYPE).alias(S.MARGIN_SUM),
        F.count(margin).alias(S.MARGIN_LINES),
    ]


def sales_fact(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Lazy sales fact with the requested columns (default: all + row keys)."""
    wanted = list(columns) if columns is not None else list(S.FACT_COLUMNS)
    unknown = set(wanted) - set(S.FACT_COLUMNS)
    if unknown:
        raise ValueError(f"unknown sales columns: {sorted(unknown)}")
    if S.PART_COLUMNS & set(wanted):
        lines = priced_lines(spark, sf_dir)
    else:
        lines = of_known_parts(line_items(spark, sf_dir), spark, sf_dir)
    if S.ORDER_COLUMNS & set(wanted):
        at = F.col(S.ORDER_ID) == F.col("o_orderkey")
        return lines.join(order_dimension(spark, sf_dir), at).select(*wanted)
    return of_valid_orders(lines, spark, sf_dir).select(*wanted)


def with_order_columns(lines: DataFrame, spark: SparkSession, sf_dir: str, columns: Iterable[str]) -> DataFrame:
    """``lines`` (with ``order_id``) given the columns of their order after the fact: late, for the few that stay.

    They meet their orders first, so that no other order meets its customer.
    """
    orders = lines.join(order_columns(spark, sf_dir), F.col(S.ORDER_ID) == F.col("o_orderkey"))
    return orders.join(customer_dimension(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")).select(*columns)


def line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_id, order_date, lines``: the fact's lines per order, from keys alone."""
    keys = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias(S.ORDER_ID), F.col("l_partkey").alias(S.PART_KEY)
    )
    per_order = of_known_parts(keys, spark, sf_dir).groupBy(S.ORDER_ID).agg(F.count(F.lit(1)).alias(S.LINES))
    orders = valid_orders(spark, sf_dir).withColumnRenamed("o_orderdate", S.ORDER_DATE)
    return per_order.join(orders, F.col(S.ORDER_ID) == F.col("o_orderkey")).drop("o_orderkey")


def order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: its attributes, and its lines summed up.

    Lines are reduced per order before the order join.  The exchange on the
    order key is needed for the join anyway; the partial sums shrink what goes
    through it, and a distinct count of orders becomes a plain count.  The
    measures keep the names of the line columns they sum; ``lines`` counts the
    lines, ``margin_sum`` and ``margin_lines`` hold the row margins (total
    form) exactly.
    """
    per_order = priced_lines(spark, sf_dir).groupBy(S.ORDER_ID).agg(*line_sums())
    orders = order_dimension(spark, sf_dir)
    return per_order.join(orders, F.col(S.ORDER_ID) == F.col("o_orderkey")).drop("o_orderkey")


def order_item_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order and item type: the lines' measures summed, and the order's attributes.

    Like ``order_totals``, lines are reduced before the order join.
    """
    sums = priced_lines(spark, sf_dir).groupBy(S.ORDER_ID, S.ITEM_TYPE).agg(*line_sums())
    orders = order_dimension(spark, sf_dir)
    return sums.join(orders, F.col(S.ORDER_ID) == F.col("o_orderkey")).drop("o_orderkey")


def order_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: order id, date, priority (no line detail)."""
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(S.ORDER_ID),
        F.col("o_orderdate").alias(S.ORDER_DATE),
        F.col("o_orderpriority").alias(S.ORDER_PRIORITY),
    )
