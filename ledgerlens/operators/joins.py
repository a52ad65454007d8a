"""The one-DAG semi-join, and broadcasts behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Rows up to which a side of known size is broadcast.
BROADCAST_ROWS = 100_000


def checked_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if ``rows``, a bound the caller has counted or proved, is small."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def restrict_to(df: DataFrame, chosen: DataFrame, keys: list[str], known_rows: int | None = None) -> DataFrame:
    """Keep the rows of ``df`` whose ``keys`` appear in ``chosen`` (left semi join).

    With ``known_rows`` (a bound the caller can prove, such as the ``k`` of a
    top-k) ``chosen`` is broadcast and the large side is not shuffled;
    otherwise Spark's own size check decides.
    """
    keys_df = chosen.select(*keys)
    return df.join(F.broadcast(keys_df) if known_rows is not None else keys_df, on=keys, how="left_semi")


def best_group(totals: DataFrame, order: list, keys: list[str]) -> DataFrame:
    """The keys of the first row by ``order`` (a few groups' totals), as a filter on its rank.

    A selective filter, unlike a limit, lets Spark prune the partitions of a
    table that is joined on the keys.
    """
    rank = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order))
    return totals.withColumn("_rank", rank).where(F.col("_rank") == 1).select(*keys)
