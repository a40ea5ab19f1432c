"""Counting and averaging at a declared grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.ratios import ratio_pct, round_to


def content_summary(df: DataFrame, kinds: Mapping[str, Column], averages: Mapping[str, tuple[str, int]], ratios: bool = False) -> DataFrame:
    """A1: one row with the total, one conditional count per kind, and rounded averages.

    ``kinds`` maps an output suffix to a condition (``total_<suffix>``, and
    ``<suffix>_ratio_pct`` when ``ratios``); ``averages`` maps an output name
    to (column, digits).
    """
    aggs = [F.count("*").alias("total_content")]
    aggs += [F.count_if(cond).alias(f"total_{name}") for name, cond in kinds.items()]
    aggs += [round_to(F.avg(col), digits).alias(out) for out, (col, digits) in averages.items()]
    if ratios:
        aggs += [ratio_pct(F.count_if(cond), F.count("*")).alias(f"{name}_ratio_pct") for name, cond in kinds.items()]
    return df.agg(*aggs)


def count_by(df: DataFrame, by: Sequence[str], out: str = "total_content", kinds: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows per group, with optional conditional counts."""
    extra = [F.count_if(cond).alias(f"total_{name}") for name, cond in (kinds or {}).items()]
    return df.groupBy(*by).agg(F.count("*").alias(out), *extra)


def entity_rollup(
    df: DataFrame,
    by: Sequence[str],
    entity: str,
    flags: Mapping[str, Column] | None = None,
    row_averages: Mapping[str, tuple[str, int]] | None = None,
    out: str = "titles_count",
    approx: bool = False,
) -> DataFrame:
    """Distinct entities per group, distinct entities per flag, and averages over the rows.

    Rows first collapse to one per (group, entity) with map-side combining, so
    many distinct counts cost one narrow shuffle instead of one copy of the
    input per measure, and a hot group is spread over its entities.
    ``approx=True`` counts with sketches instead.
    """
    flags = flags or {}
    row_averages = row_averages or {}
    if approx:
        aggs = [F.approx_count_distinct(entity).alias(out)]
        aggs += [F.approx_count_distinct(F.when(cond, F.col(entity))).alias(name) for name, cond in flags.items()]
        aggs += [round_to(F.avg(col), digits).alias(name) for name, (col, digits) in row_averages.items()]
        return df.groupBy(*by).agg(*aggs)

    per_entity = [F.coalesce(F.bool_or(cond), F.lit(False)).alias(f"_f_{name}") for name, cond in flags.items()]
    for name, (col, _) in row_averages.items():
        per_entity += [F.sum(col).alias(f"_s_{name}"), F.count(col).alias(f"_n_{name}")]
    known = F.col(entity).isNotNull()
    grain = df.groupBy(*by, entity).agg(*per_entity) if per_entity else df.select(*by, entity).distinct()
    aggs = [F.count_if(known).alias(out)]
    aggs += [F.count_if(known & F.col(f"_f_{name}")).alias(name) for name in flags]
    aggs += [
        round_to(F.try_divide(F.sum(f"_s_{name}").cast("double"), F.sum(f"_n_{name}").cast("double")), digits).alias(name)
        for name, (_, digits) in row_averages.items()
    ]
    return grain.groupBy(*by).agg(*aggs)


def grain_average(df: DataFrame, key: str, measure: str, out: str, digits: int = 1) -> DataFrame:
    """Average over distinct (key, measure) pairs instead of over fan-out rows."""
    return df.select(key, measure).distinct().agg(round_to(F.avg(measure), digits).alias(out))


def parsed_stats(df: DataFrame, value: Column, by: Sequence[str] = (), digits: int = 2) -> DataFrame:
    """Count, average, minimum and maximum of a number parsed out of text."""
    return df.withColumn("_v", value).groupBy(*by).agg(
        F.count("*").alias("n"),
        round_to(F.avg("_v"), digits).alias("avg_value"),
        F.min("_v").alias("min_value"),
        F.max("_v").alias("max_value"),
    )


def denominator_audit(df: DataFrame, value: Column, by: Sequence[str] = (), digits: int = 1) -> DataFrame:
    """How many rows an average is really over: total, with and without the value."""
    return df.withColumn("_v", value).groupBy(*by).agg(
        F.count("*").alias("total_rows"),
        F.count("_v").alias("with_value"),
        F.count_if(F.col("_v").isNull()).alias("missing_value"),
        F.sum("_v").cast("long").alias("value_sum"),
        round_to(F.avg("_v"), digits).alias("avg_rounded"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing values of many columns in one scan, as (column_name, null_count) rows."""
    wide = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in cols))
    return wide.unpivot([], list(cols), "column_name", "null_count")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The row count of each table, as (table_name, row_count) rows."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def grain_audit(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, distinct keys and duplication factor of each table.

    ``tables`` maps a name to (frame, key column). Rows collapse per key
    before counting, so the distinct count is an ordinary count.
    """
    parts = []
    for name, (df, key) in tables.items():
        per_key = df.groupBy(key).agg(F.count("*").alias("_n"))
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
                F.count(key).alias("distinct_keys"),
            ).select(
                F.lit(name).alias("table_name"),
                "total_rows",
                "distinct_keys",
                round_to(F.try_divide(F.col("total_rows").cast("double"), F.col("distinct_keys").cast("double")), 3).alias("duplication_factor"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def share_of_total(df: DataFrame, measure: str, out: str = "percentage_share", digits: int = 2) -> DataFrame:
    """Each group's percentage of the grand total.

    The total is a scalar subquery over the grouped frame, so the groups never
    gather in one task as they would for an un-partitioned window.
    """
    total = df.agg(F.sum(measure)).scalar()
    return df.withColumn(out, ratio_pct(F.col(measure), total, digits))


def shares(df: DataFrame, count_col: str, entities: DataFrame, entity: str) -> DataFrame:
    """Share of the catalog (distinct entities) next to share of all assignments."""
    catalog_total = entities.agg(F.count_distinct(entity)).scalar()
    return share_of_total(df, count_col, "assignment_share").withColumn(
        "catalog_share", ratio_pct(F.col(count_col), catalog_total)
    )


def assignment_total(df: DataFrame, by: str, entity: str) -> DataFrame:
    """The sum over groups of their distinct entities."""
    return df.select(by, entity).distinct().agg(F.count(entity).alias("assignment_total"))
