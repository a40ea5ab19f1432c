"""Calendar keys and attributes (P10, P13, P17, P18). The as-of year is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_DATE_KEY = -1


def age_in_years(year: Column, as_of_year: int) -> Column:
    return F.lit(as_of_year) - year


def is_recent(year: Column, as_of_year: int, window: int = 5) -> Column:
    return year >= F.lit(as_of_year - window)


def decade_label(year: Column) -> Column:
    """1998 becomes "1990s"."""
    return F.concat((F.floor(year / 10) * 10).cast("string"), F.lit("s"))


def date_key(day: Column) -> Column:
    """yyyyMMdd as an integer, -1 for a missing date."""
    key = F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
    return F.coalesce(key, F.lit(UNKNOWN_DATE_KEY))


def calendar_columns(day: Column) -> dict[str, Column]:
    """year, month, day, quarter and day of week (Sunday is 1)."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "quarter": F.quarter(day),
        "day_of_week": F.dayofweek(day),
    }
