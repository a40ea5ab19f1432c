"""Rounding, ratios and unit splits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(c: Column, digits: int) -> Column:
    """Decimal half-up rounding, returned as double (1.005 to two digits is 1.01)."""
    return F.round(c.cast("decimal(38,10)"), digits).cast("double")


def ratio_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """P20: 100 * part / whole rounded; NULL when the whole is zero."""
    return round_to(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), digits)


def split_minutes(minutes: Column) -> tuple[Column, Column]:
    """Whole hours and the remaining minutes, rounded half-to-even."""
    return F.floor(minutes / 60).cast("int"), F.bround(minutes % 60, 0).cast("int")
