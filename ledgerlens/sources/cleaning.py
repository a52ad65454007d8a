"""Typing raw text columns: strict and lenient date parsing, numeric coercion.

Strict parsing (``to_date`` / ``to_timestamp`` under ANSI) fails the job on a
malformed value; lenient parsing (``try_*``) turns it into null so that the
row can be dropped or quarantined.  All of it is JVM-side column expressions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schema as S

SALES_DATE_FORMAT = "M/d/yyyy"

# Target type of each numeric sales column after coercion.
NUMERIC_TYPES: dict[str, T.DataType] = {
    S.UNITS_SOLD: S.UNITS_TYPE,
    S.UNIT_PRICE: T.DoubleType(),
    S.UNIT_COST: T.DoubleType(),
    S.TOTAL_REVENUE: S.MONEY_TYPE,
    S.TOTAL_COST: S.MONEY_TYPE,
    S.TOTAL_PROFIT: S.MONEY_TYPE,
    S.ORDER_ID: T.LongType(),
}


def strict_date(c: str | Column, fmt: str = SALES_DATE_FORMAT) -> Column:
    """Parse text to DATE; malformed text raises under ANSI mode."""
    return F.to_date(F.col(c) if isinstance(c, str) else c, fmt)


def strict_timestamp(c: str | Column, fmt: str = SALES_DATE_FORMAT) -> Column:
    return F.to_timestamp_ntz(F.col(c) if isinstance(c, str) else c, F.lit(fmt))


def lenient_timestamp(c: str | Column, fmt: str = SALES_DATE_FORMAT) -> Column:
    """Parse text to a day as TIMESTAMP_NTZ; malformed, empty or null text gives null.

    No time zone is involved, so a day never moves.  Accepts both ``5/8/2012`` and ``05/08/2012`` for ``M/d/yyyy``.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_date(col, fmt).cast(T.TimestampNTZType())


def lenient_date(c: str | Column, fmt: str = SALES_DATE_FORMAT) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_date(col, fmt)


TEXT_COLUMNS = (S.REGION, S.COUNTRY, S.ITEM_TYPE, S.SALES_CHANNEL, S.ORDER_PRIORITY)


def trim_text(df: DataFrame) -> DataFrame:
    """Names without blanks around them: ``Mali`` and ``Mali `` are one country."""
    return df.withColumns({c: F.trim(F.col(c)) for c in TEXT_COLUMNS if c in df.columns})


def coerce_numeric(df: DataFrame, types: Mapping[str, T.DataType] | None = None) -> DataFrame:
    """``try_cast`` each listed text column to its numeric type in one projection."""
    targets = {k: v for k, v in (types or NUMERIC_TYPES).items() if k in df.columns}
    return df.withColumns(
        {name: F.trim(F.col(name)).try_cast(dtype) for name, dtype in targets.items()}
    )


def drop_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def clean_sales_text(df: DataFrame, date_format: str = SALES_DATE_FORMAT) -> DataFrame:
    """Raw sales text (all strings) -> typed sales rows.

    Dates leniently parsed, names trimmed, seven numeric columns coerced, rows without an
    order date dropped; other malformed values stay as nulls.
    """
    typed = df.withColumns(
        {
            S.ORDER_DATE: lenient_timestamp(S.ORDER_DATE, date_format),
            S.SHIP_DATE: lenient_timestamp(S.SHIP_DATE, date_format),
        }
    )
    typed = coerce_numeric(trim_text(typed))
    return drop_null(typed, [S.ORDER_DATE])
