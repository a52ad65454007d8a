"""Sorting, top-k, top-k per group and row-position slices."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_n(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows by ``order`` (include unique columns for a total order).

    For report-sized ``n``: every task keeps ``n`` rows and one merges them.
    """
    return df.orderBy(*_cols(order)).limit(n)


def top_n_per_group(
    df: DataFrame,
    group: Sequence[str],
    n: int,
    order: Sequence[str | Column],
    rank_col: str = "rank_in_group",
    keep_rank: bool = False,
) -> DataFrame:
    """``row_number() <= n`` per group.

    Written as ``rn <= n`` so Catalyst inserts a partial ``WindowGroupLimit``
    before the shuffle: each map task forwards at most ``n`` rows per group,
    which keeps a group holding a third of all rows from landing in one task.
    """
    w = Window.partitionBy(*group).orderBy(*_cols(order))
    ranked = df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
    return ranked if keep_rank else ranked.drop(rank_col)


def position_counts(counts: DataFrame, lead: str, block: str | None = None) -> DataFrame:
    """``lead, [block,] n, before``: rows of each value of the leading sort columns, and rows before it.

    ``counts`` has one row per value.  The running sum over ``lead`` is one
    task, which suits a leading column with a bounded domain, such as a time;
    the blocks within each of its values are summed value by value.
    """
    totals = counts.groupBy(lead).agg(F.sum("n").alias("n")) if block else counts
    running = F.sum("n").over(Window.orderBy(lead).rowsBetween(Window.unboundedPreceding, -1))
    placed = totals.select(lead, "n", F.coalesce(running, F.lit(0)).alias("before"))
    if block is None:
        return placed
    inside = F.sum("n").over(
        Window.partitionBy(lead).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = counts.select(lead, block, "n", F.coalesce(inside, F.lit(0)).alias("_inside"))
    placed = placed.select(F.col(lead).alias("_at"), "before")
    return blocks.join(placed, F.col(lead).eqNullSafe(F.col("_at"))).select(
        lead, block, "n", (F.col("before") + F.col("_inside")).alias("before")
    )


def slice_rows(
    df: DataFrame,
    order: Sequence[str],
    start: int,
    stop: int,
    pos_col: str = "pos",
    counts: DataFrame | None = None,
    block: str | None = None,
    covered: DataFrame | None = None,
) -> DataFrame:
    """Rows at 0-based positions ``[start, stop)`` of the order by ``order`` (columns, ascending).

    The rows are counted by the leading column; the running counts say which of
    its values the slice covers and at which position each begins.  Only rows
    with those values are ranked, each value on its own.  There are at most
    ``stop - start`` such values, so they are broadcast.

    ``order`` needs key columns after the leading one; rows that tie in all of
    it get neighbouring positions in no fixed order.  ``block`` names a column
    that rises with the rest of the order (such as the key divided by a range):
    a crowded value of the leading column is then counted and ranked block by
    block.  ``counts`` may give the counts (``lead, [block,] n``) where they are
    known, ``covered`` what ``covered_counts`` gives for the slice.
    """
    start = max(0, int(start))
    stop = max(start, int(stop))
    lead, rest = order[0], list(order[1:])
    if not rest:
        raise ValueError("the order needs key columns after the leading one")
    at = [lead] + ([block] if block else [])
    if covered is None:
        counts = df.groupBy(*at).agg(F.count(F.lit(1)).alias("n")) if counts is None else counts
        covered = covered_counts(position_counts(counts, lead, block), start, stop)
    covered = covered.select(*[F.col(c).alias(f"_{c}") for c in at], F.col("before").alias("_before"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in at])
    rows = df.join(F.broadcast(covered), same)
    w = Window.partitionBy(*[f"_{c}" for c in at]).orderBy(*rest)
    placed = rows.withColumn(pos_col, (F.col("_before") + F.row_number().over(w) - 1).cast("bigint"))
    return placed.where((F.col(pos_col) >= start) & (F.col(pos_col) < stop)).drop(*[f"_{c}" for c in at], "_before")


def covered_counts(positions: DataFrame, start: int, stop: int) -> DataFrame:
    """The values of ``position_counts`` that hold a position of ``[start, stop)``: ``stop - start`` at most."""
    return positions.where((F.col("before") < stop) & (F.col("before") + F.col("n") > start))


def first_days(per_day: DataFrame, day: str, n: int, newest: bool = False):
    """The day up to which (from the earliest, or ``newest``) ``n`` rows are counted; None if there are fewer.

    ``per_day`` has one row per day with its rows ``n``.
    """
    order = F.desc(day) if newest else F.asc(day)
    running = F.sum("n").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    reached = per_day.where(F.col(day).isNotNull()).select(day, running.alias("upto")).where(F.col("upto") >= n)
    return reached.agg((F.max if newest else F.min)(day)).first()[0]
