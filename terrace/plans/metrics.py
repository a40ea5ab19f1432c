"""Metric catalog, reconciliation and cross-layer checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.ratios import ratio_pct, round_to

AGGREGATIONS = ("count", "ratio_pct", "avg", "min", "max")


@dataclass(frozen=True)
class Metric:
    """One declared metric.

    ``grain`` names the key columns rows are made distinct on before
    aggregating (with the measured column); empty means rows as they are.
    ``filter`` limits the rows, or marks the counted ones for ``ratio_pct``.
    """

    name: str
    source: str
    aggregation: str
    column: str | None = None
    grain: tuple[str, ...] = ()
    filter: str | None = None
    digits: int = 2
    unit: str = ""

    def expression(self) -> Column:
        cond = F.expr(self.filter) if self.filter else F.lit(True)
        value = F.when(cond, F.expr(self.column)) if self.column else F.when(cond, F.lit(1))
        match self.aggregation:
            case "count":
                out = F.count(value)
            case "ratio_pct":
                out = ratio_pct(F.count_if(cond), F.count("*"), self.digits)
            case "avg":
                out = round_to(F.avg(value), self.digits)
            case "min":
                out = F.min(value)
            case "max":
                out = F.max(value)
            case other:
                raise ValueError(f"unknown aggregation: {other}")
        return out.cast("double")


def evaluate_metrics(sources: Mapping[str, DataFrame], catalog: Sequence[Metric]) -> DataFrame:
    """The catalog as (metric, value, unit) rows.

    Metrics on the same source and grain share one aggregation, so a source is
    read once per grain however many metrics it has.
    """
    groups: dict[tuple[str, tuple[str, ...]], list[Metric]] = {}
    for m in catalog:
        groups.setdefault((m.source, m.grain), []).append(m)
    parts = []
    for (source, grain), metrics in groups.items():
        df = sources[source]
        if grain:
            df = df.select(*grain).distinct()
        wide = df.agg(*(m.expression().alias(m.name) for m in metrics))
        entries = [F.struct(F.lit(m.name).alias("metric"), F.col(m.name).alias("value"), F.lit(m.unit).alias("unit")) for m in metrics]
        parts.append(wide.select(F.inline(F.array(*entries))))
    return reduce(DataFrame.unionByName, parts)


def reconcile(expected: DataFrame, actual: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Expected against actual metrics, with a status and a mismatch class per metric."""
    e, a = expected.alias("e"), actual.alias("a")
    joined = e.join(a, F.col("e.metric") == F.col("a.metric"), "left")
    off = F.abs(F.col("e.value") - F.col("a.value")) > tolerance
    mismatch = (
        F.when(F.col("a.metric").isNull(), F.lit("METRIC_MISMATCH"))
        .when(~F.col("e.unit").eqNullSafe(F.col("a.unit")), F.lit("UNIT_MISMATCH"))
        .when(off | F.col("a.value").isNull(), F.lit("NUMERIC_MISMATCH"))
    )
    return joined.select(
        F.col("e.metric").alias("metric"),
        F.col("e.value").alias("expected_value"),
        F.col("a.value").alias("actual_value"),
        F.when(mismatch.isNull(), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        F.coalesce(mismatch, F.lit("NONE")).alias("mismatch_class"),
    )


def reconciliation_totals(report: DataFrame) -> DataFrame:
    """Metrics per status and mismatch class."""
    return report.groupBy("status", "mismatch_class").agg(F.count("*").alias("metrics"))


def across_layers(values: Mapping[str, DataFrame]) -> DataFrame:
    """The same one-row metrics measured in several layers, as (layer, metric, value) rows."""
    parts = []
    for layer, df in values.items():
        wide = df.select(*(F.col(c).cast("double").alias(c) for c in df.columns))
        parts.append(wide.unpivot([], df.columns, "metric", "value").select(F.lit(layer).alias("layer"), "metric", "value"))
    return reduce(DataFrame.unionByName, parts)
