"""Text cleaning and tolerant parsing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def squash_space(c: Column) -> Column:
    """P5: runs of whitespace become one blank, ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def blank_to_null(c: Column) -> Column:
    """The empty string means missing."""
    return F.nullif(c, F.lit(""))


def fill_blank(c: Column, default: str = "Unknown") -> Column:
    """NULL or blank text becomes ``default``."""
    return F.when(F.trim(c) != "", c).otherwise(F.lit(default))


def canonicalize(c: Column, spellings: Mapping[str, str] | list[str]) -> Column:
    """Known values get their canonical spelling whatever their case; others get initcap.

    ``spellings`` is a list of canonical values, or a map from any lower-case
    spelling to its canonical value.
    """
    if not isinstance(spellings, Mapping):
        spellings = {value.lower(): value for value in spellings}
    tidy = F.trim(c)
    folded = F.lower(tidy)
    out = F.initcap(tidy)
    for known, canonical in spellings.items():
        out = F.when(folded == known.lower(), F.lit(canonical)).otherwise(out)
    return out


def parse_date(c: Column, fmt: str = "MMMM d, yyyy") -> Column:
    """Date in ``fmt``, NULL where the text does not fit."""
    return F.try_to_timestamp(F.trim(c), F.lit(fmt)).cast("date")


def unparsed(raw: Column, parsed: Column) -> Column:
    """text was given but did not parse (never NULL, so its negation is the exact complement)."""
    return parsed.isNull() & F.coalesce(F.trim(raw) != "", F.lit(False))


def safe_int(c: Column) -> Column:
    """Integer, or NULL where the text is not one."""
    return c.try_cast("int")


def parse_quantity(c: Column, unit_pattern: str, when: Column) -> Column:
    """The number in front of a unit ("90 min", "2 Seasons") on rows where ``when`` holds."""
    return F.when(when, F.regexp_extract(c, rf"(\d+)\s*{unit_pattern}", 1).try_cast("int"))


def leading_int(c: Column) -> Column:
    """Integer before the first blank."""
    return F.split_part(c, F.lit(" "), F.lit(1)).try_cast("int")
