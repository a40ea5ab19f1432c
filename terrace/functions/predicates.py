"""Row predicates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newer_than(df: DataFrame, ts: str, watermark: datetime, day: str | None = None) -> DataFrame:
    """rows strictly after the high-water mark.

    The mark becomes a literal of the column's own type, so it is pushed down
    to the files; ``day``, the partition column holding the timestamp's date,
    prunes whole directories as well.
    """
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        mark = F.lit(watermark.isoformat(sep=" ")).cast("timestamp_ntz")
    else:
        mark = F.lit(watermark)
    if day:
        df = df.filter(F.col(day) >= F.to_date(mark))
    return df.filter(F.col(ts) > mark)


def any_changed(left: str, right: str, cols: Iterable[str]) -> Column:
    """some compared column differs between two join aliases, NULL being equal to NULL."""
    tests = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def not_in_set(c: Column, allowed: Iterable[Any]) -> Column:
    """a value was given and is outside the set (NULL is tolerated)."""
    return c.isNotNull() & ~c.isin(list(allowed))


def without(df: DataFrame, col: str, *sentinels: str) -> DataFrame:
    """drop placeholder members such as "Unknown Country"."""
    return df.filter(~F.col(col).isin(list(sentinels)))


def apply_filters(df: DataFrame, context: Mapping[str, Any] | None, columns: Mapping[str, str]) -> DataFrame:
    """F8: add a filter for each context entry that is present.

    ``columns`` maps the filter names (country, genre, type, year) to columns
    of ``df``; ``start_year``/``end_year`` use the year column. Values are
    literals, never spliced into SQL text.
    """
    context = {k: v for k, v in (context or {}).items() if v is not None and v != ""}
    for name in ("country", "genre", "type", "year"):
        if name in context:
            df = df.filter(F.col(columns[name]) == F.lit(context[name]))
    if "start_year" in context:
        df = df.filter(F.col(columns["year"]) >= F.lit(int(context["start_year"])))
    if "end_year" in context:
        df = df.filter(F.col(columns["year"]) <= F.lit(int(context["end_year"])))
    return df
