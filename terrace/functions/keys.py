"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*parts: Column | str) -> Column:
    """64-bit hash of the natural key. NULL parts hash like absent ones, so fill blanks first."""
    return F.xxhash64(*parts)
