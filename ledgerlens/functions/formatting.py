"""Display formats of the dashboard cards (JVM-side string functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_text(c: str | Column) -> Column:
    """``$1,234`` (whole currency units, thousands separators)."""
    return F.concat(F.lit("$"), F.format_number(_col(c), 0))


def percent_text(c: str | Column, digits: int = 2) -> Column:
    """``12.34%``."""
    return F.concat(F.format_number(_col(c), digits), F.lit("%"))


def count_text(c: str | Column) -> Column:
    """``1,234``."""
    return F.format_number(_col(c), 0)
