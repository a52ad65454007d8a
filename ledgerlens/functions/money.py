"""Exact money and margin expressions.

Money is summed as DECIMAL and only cast to DOUBLE at the end, so a total does
not depend on how tasks combine partial sums (double addition is not
associative).  Means are written as ``double(exact sum) / count`` for the same
reason.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARGIN_TYPE = T.DecimalType(18, 2)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hundredths(c: str | Column) -> Column:
    """A double in whole hundredths, half away from zero: exact integers, not decimals.

    The product of two is a money value in ten-thousandths.  Integer arithmetic
    stays in generated code, where a cast to decimal goes by way of text.
    """
    x = _col(c) * F.lit(100.0)
    return F.when(x < 0, -F.floor(F.lit(0.5) - x)).otherwise(F.floor(x + F.lit(0.5)))


def exact(units: Column, digits: int, dtype: T.DecimalType) -> Column:
    """Whole units of ``10 ** -digits`` as an exact decimal."""
    one = F.lit(Decimal(1).scaleb(-digits)).cast(T.DecimalType(digits + 1, digits))
    return (units.cast(T.DecimalType(18, 0)) * one).cast(dtype)


def money_sum(c: str | Column) -> Column:
    """Exact sum of a decimal column, returned as DOUBLE (null for no rows)."""
    return F.sum(_col(c)).cast("double")


def money_sum_or_zero(c: str | Column) -> Column:
    return F.coalesce(money_sum(c), F.lit(0.0))


def units_sum(c: str | Column) -> Column:
    return F.sum(_col(c)).cast("double")


def exact_mean(c: str | Column, exact_type: T.DecimalType) -> Column:
    """Mean of a column whose values are exact in ``exact_type``; nulls skipped."""
    col = _col(c)
    return F.try_divide(F.sum(col.cast(exact_type)).cast("double"), F.count(col))


def margin_unit_pct(price: str | Column, cost: str | Column, digits: int = 2) -> Column:
    """Per-row margin from unit prices: ``round((price - cost) / price * 100, digits)``.

    A zero price gives null (not an error, not infinity); ``avg`` skips it.
    """
    p, c = _col(price), _col(cost)
    return F.round(F.try_divide(p - c, p) * F.lit(100.0), digits)


def margin_total_pct(profit: str | Column, revenue: str | Column, digits: int = 2) -> Column:
    """Per-row margin from totals: ``round(profit / revenue * 100, digits)``."""
    pr = _col(profit).cast("double")
    rv = _col(revenue).cast("double")
    return F.round(F.try_divide(pr, rv) * F.lit(100.0), digits)


def mean_margin(c: str | Column) -> Column:
    """Row average of 2-digit margins (the dashboard's "average margin")."""
    total = F.sum(hundredths(c).cast(T.DecimalType(18, 0))) * F.lit(Decimal("0.01"))
    return F.try_divide(total.cast("double"), F.count(_col(c)))
