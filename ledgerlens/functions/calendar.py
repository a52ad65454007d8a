"""Calendar and event-time column expressions (all JVM built-ins)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_of(c: str | Column) -> Column:
    return F.year(_col(c))


def month_of(c: str | Column) -> Column:
    """Month of year 1-12, years pooled (seasonality)."""
    return F.month(_col(c))


def month_label(c: str | Column) -> Column:
    """Calendar month as ``yyyy-MM`` text."""
    return F.date_format(_col(c), "yyyy-MM")


def day_label(c: str | Column) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd")


def weekday_mon0(c: str | Column) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(_col(c))


def is_weekend(c: str | Column) -> Column:
    return weekday_mon0(c).isin(5, 6)


def hour_floor(c: str | Column) -> Column:
    return F.date_trunc("hour", _col(c))


def hour_label(c: str | Column) -> Column:
    """Event time floored to the hour as ``yyyy-MM-dd HH:mm`` text."""
    return F.date_format(hour_floor(c), "yyyy-MM-dd HH:mm")


def event_time(date_col: str | Column, id_col: str | Column) -> Column:
    """Synthetic event time: date + (id mod 24) hours + (id mod 60) minutes.

    A null id counts as 0.  ``pmod`` keeps the offsets non-negative for negative
    ids (floor semantics).
    """
    k = F.coalesce(_col(id_col).cast("bigint"), F.lit(0).cast("bigint"))
    return _col(date_col) + F.make_dt_interval(
        F.lit(0), F.pmod(k, F.lit(24)), F.pmod(k, F.lit(60))
    )


def _boundary(year: int, dtype: T.DataType) -> Column:
    """Literal 1 January of ``year`` typed like the filtered column.

    Matching the column type keeps the comparison free of casts on the column,
    so the predicate reaches the parquet reader.
    """
    day = dt.date(year, 1, 1)
    if isinstance(dtype, T.DateType):
        return F.lit(day)
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(day.isoformat()).cast(T.TimestampNTZType())
    return F.lit(day.isoformat()).cast(T.TimestampType())


def year_ranges(years: Iterable[int]) -> list[tuple[int, int]]:
    """Collapse years into half-open ranges ``[first, last + 1)``."""
    ranges: list[tuple[int, int]] = []
    for y in sorted({int(y) for y in years}):
        if ranges and ranges[-1][1] == y:
            ranges[-1] = (ranges[-1][0], y + 1)
        else:
            ranges.append((y, y + 1))
    return ranges


def years_predicate(df: DataFrame, column: str, years: Iterable[int]) -> Column:
    """``year(column) IN years`` rewritten as date ranges.

    ``year(d) IN (...)`` cannot be pushed into a parquet scan, plain range
    comparisons can (and prune row groups by their min/max statistics).
    """
    dtype = df.schema[column].dataType
    c = F.col(column)
    ranges = year_ranges(years)
    if not ranges:
        return F.lit(False)
    pred = None
    for lo, hi in ranges:
        p = (c >= _boundary(lo, dtype)) & (c < _boundary(hi, dtype))
        pred = p if pred is None else (pred | p)
    return pred
