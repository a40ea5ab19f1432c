"""Threshold labels and bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def two_way(flag: Column, yes: str, no: str) -> Column:
    """A label for a boolean; an unknown flag falls to ``no``."""
    return F.when(flag, F.lit(yes)).otherwise(F.lit(no))


def bands(value: Column, steps: Sequence[tuple[Column, str]], last: str) -> Column:
    """First label whose condition holds, else ``last`` (also for a missing value)."""
    out = F.lit(last)
    for condition, label in reversed(steps):
        out = F.when(condition, F.lit(label)).otherwise(out)
    return out


def below(value: Column, *limits: tuple[float, str]) -> list[tuple[Column, str]]:
    """Steps for :func:`bands` from (exclusive upper limit, label) pairs."""
    return [(value < limit, label) for limit, label in limits]
