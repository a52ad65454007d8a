"""Row filters of the dashboard and the business questions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.functions.calendar import is_weekend, years_predicate


def _and(preds: list[Column]) -> Column | None:
    return reduce(lambda a, b: a & b, preds) if preds else None


# Partition column of a materialised fact (see ledgerlens.sources.materialize).
ORDER_YEAR = "order_year"


def _years(df: DataFrame, date_col: str, years: Sequence[int]) -> Column:
    """Year selection as date ranges; on a frame partitioned by order year the
    same selection is added on the partition column so folders are pruned."""
    pred = years_predicate(df, date_col, years)
    if ORDER_YEAR in df.columns and date_col == S.ORDER_DATE:
        pred = pred & F.col(ORDER_YEAR).isin([int(y) for y in years])
    return pred


def optional_filter(
    df: DataFrame,
    years: Sequence[int] | None = None,
    regions: Sequence[str] | None = None,
    channels: Sequence[str] | None = None,
    date_col: str = S.ORDER_DATE,
) -> DataFrame:
    """API-style selection: a missing *or empty* list means "no filter"."""
    preds = []
    if years:
        preds.append(_years(df, date_col, years))
    if regions:
        preds.append(F.col(S.REGION).isin(list(regions)))
    if channels:
        preds.append(F.col(S.SALES_CHANNEL).isin(list(channels)))
    pred = _and(preds)
    return df if pred is None else df.where(pred)


def strict_filter(
    df: DataFrame,
    years: Sequence[int] | None = None,
    regions: Sequence[str] | None = None,
    channels: Sequence[str] | None = None,
    date_col: str = S.ORDER_DATE,
) -> DataFrame:
    """Dashboard-style selection: an *empty* list matches nothing.

    ``None`` stands for the widget default (everything selected).
    """
    preds = []
    if years is not None:
        preds.append(_years(df, date_col, years) if years else F.lit(False))
    if regions is not None:
        preds.append(F.col(S.REGION).isin(list(regions)) if regions else F.lit(False))
    if channels is not None:
        preds.append(F.col(S.SALES_CHANNEL).isin(list(channels)) if channels else F.lit(False))
    pred = _and(preds)
    return df if pred is None else df.where(pred)


def weekend_in_region(df: DataFrame, region: str, date_col: str = S.ORDER_DATE) -> DataFrame:
    """Orders of one region placed on a Saturday or Sunday."""
    return df.where((F.col(S.REGION) == F.lit(region)) & is_weekend(date_col))
