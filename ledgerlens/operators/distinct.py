"""Exact distinct counts that merge: bitmaps of ids.

``count(distinct id)`` can't be added up over groups and shuffles every id for
each grouping.  A bitmap holds the ids of one range of 32,768 exactly, and the
bitmaps of a range are merged by OR: ids are read once, each task first makes
its own bitmaps, and every coarser grouping is a merge of what is there.

A bitmap is 4 KB however few ids it holds, so group by few keys whose ids are
dense (months, regions), not by keys that split ids finely.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ID_RANGE, BITS = "id_range", "bits"


def id_bitmaps(rows: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """``keys, id_range, bits``: the ids of each group; null ids are none."""
    ids = rows.where(F.col(id_col).isNotNull())
    return ids.groupBy(*keys, F.bitmap_bucket_number(id_col).alias(ID_RANGE)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias(BITS)
    )


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser groups."""
    return bitmaps.groupBy(*keys, ID_RANGE).agg(F.bitmap_or_agg(BITS).alias(BITS))


def count_ids(bitmaps: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    """Distinct ids of each group (one row without keys, 0 if there are none)."""
    counted = merge_bitmaps(bitmaps, keys).select(*keys, F.bitmap_count(BITS).alias("_n"))
    total = F.coalesce(F.sum("_n"), F.lit(0)).alias(alias)
    return counted.groupBy(*keys).agg(total) if keys else counted.agg(total)
