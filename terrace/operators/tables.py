"""Whole-table operators: alignment, de-duplication, upsert, unions, list columns."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions import text


# A join's side is broadcast up to this many rows.
FEW = 100_000
# Rows a task takes where both sides of a join are dealt by counted rows.
TASK_ROWS = 500_000


# --- joins --------------------------------------------------------------------------------------


def looks_small(df: DataFrame) -> bool:
    """Whether Spark estimates a frame below its broadcast limit."""
    limit = int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def is_small(df: DataFrame, few: int = FEW) -> bool:
    """Whether Spark estimates a frame below its broadcast limit and it holds few rows.

    The estimate is of compressed files, of which a few MB may hold millions of rows, so it is not trusted alone; rows
    are counted where it is low.
    """
    return looks_small(df) and df.count() <= few


def by_rows(df: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The right side of a join: broadcast where it holds few rows, else sorted and merged, which bounds the driver's memory.

    ``stored`` is the table that decides, where ``df`` holds no more rows than it and is itself a join.
    """
    return df.hint("broadcast" if is_small(df if stored is None else stored) else "merge")


# --- columns of a table -------------------------------------------------------------------------


def stamp_audit(
    df: DataFrame,
    *,
    batch_id: str,
    run_id: str,
    source_system: str,
    source_file: str | None,
    load_type: str,
    now: datetime,
) -> DataFrame:
    """Add the seven audit columns. ``source_file=None`` records each row's own input file."""
    stamp = F.lit(now).cast("timestamp")
    # The names of the audit columns.
    return df.withColumns(
        {
            "batch_id": F.lit(batch_id),
            "pipeline_run_id": F.lit(run_id),
            "ingestion_timestamp": stamp,
            "source_system": F.lit(source_system),
            "source_file": F.lit(source_file) if source_file else F.col("_metadata.file_path"),
            "load_type": F.lit(load_type.upper()),
            "ingestion_date": F.to_date(stamp),
        }
    )


def normalize_names(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename legacy columns, except where the standard name is already there."""
    todo = {old: new for old, new in renames.items() if old in df.columns and new not in df.columns}
    return df.withColumnsRenamed(todo)


def ensure_columns(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add the columns that are missing."""
    return df.withColumns({c: v for c, v in defaults.items() if c not in df.columns})


def harmonize(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Give shared columns one type before a union."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in casts.items() if c in df.columns})


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The target's columns in the target's order; extras dropped, missing ones NULL."""
    return df.select(
        *(
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty strings become NULL in every string column."""
    return df.select(
        *(
            text.blank_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        )
    )


# --- keys ---------------------------------------------------------------------------------------


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    The rank filter is pushed below the shuffle as a group limit, so a hot key
    sends at most one row per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def matching(df: DataFrame, keys: DataFrame, on: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows with (or for ``left_anti`` without) one of the keys, where a NULL key equals a NULL key."""
    ours, theirs = df.alias("ours"), keys.select(*on).alias("theirs")
    same = reduce(lambda a, b: a & b, (F.col(f"ours.{c}").eqNullSafe(F.col(f"theirs.{c}")) for c in on))
    return ours.join(by_rows(theirs), same, how)


def filtered_by(df: DataFrame, keys: DataFrame, on: str, how: str) -> DataFrame:
    """Rows with (``left_semi``) or without (``left_anti``) one of the keys.

    Few keys are broadcast. Else the keys are dealt over tasks of about ``TASK_ROWS`` counted rows of ``df``, and Spark deals the rows
    alike (finer, where the session's number of partitions is larger). So what a task sorts does not grow with the tables.
    """
    keys = keys.select(on)
    if is_small(keys):
        return df.join(F.broadcast(keys), on, how)
    tasks = max(math.ceil(df.count() / TASK_ROWS), 1)
    return df.join(keys.repartition(tasks, on).hint("merge"), on, how)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], on_conflict: str = "update") -> DataFrame:
    """Keyed upsert. ``source`` holds one row per key; ``on_conflict`` is "update" or "nothing"."""
    source = align_to(source, target.schema)
    if on_conflict == "update":
        return target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns).unionByName(source)
    if on_conflict == "nothing":
        # The target is reduced to the incoming keys first, so only those keys meet the anti join.
        known = target.select(*keys).join(source.select(*keys), list(keys), "left_semi").distinct()
        return target.unionByName(source.join(known, list(keys), "left_anti").select(*target.columns))
    raise ValueError(f"unknown conflict policy: {on_conflict}")


def delete_keys(df: DataFrame, doomed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Drop the rows whose key is listed."""
    return df.join(doomed.select(*on), list(on), "left_anti")


def delete_cascade(parent: DataFrame, child: DataFrame, doomed: DataFrame, on: str, link: str) -> tuple[DataFrame, DataFrame]:
    """Delete parents by natural key ``on`` and the child rows that point at them through ``link``."""
    gone = parent.join(doomed.select(on), on, "left_semi").select(link)
    return delete_keys(parent, doomed, [on]), delete_keys(child, gone, [link])


# --- unions -------------------------------------------------------------------------------------


def union_sources(sources: Sequence[DataFrame], how: str = "intersect") -> DataFrame:
    """Stack sources by column name, on the common columns or on all of them."""
    if how == "outer":
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    if how != "intersect":
        raise ValueError(f"unknown union mode: {how}")
    shared = [c for c in sources[0].columns if all(c in s.columns for s in sources)]
    return reduce(DataFrame.unionByName, [s.select(*shared) for s in sources])


def labelled_union(tables: Mapping[str, DataFrame], label: str = "table_name") -> DataFrame:
    """U4: UNION ALL of like-shaped tables, each row tagged with its table's name."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias(label), "*") for name, df in tables.items()])


def add_default_member(dim: DataFrame, member: Mapping[str, Any]) -> DataFrame:
    """Append one fixed row (columns not named are NULL), also to an empty dimension."""
    one = dim.sparkSession.range(1).select(
        *(F.lit(member.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema.fields)
    )
    return dim.unionByName(one)


# --- list columns -------------------------------------------------------------------------------


def explode_list(df: DataFrame, key: str, col: str, out: str, initcap: bool = False) -> DataFrame:
    """One (key, value) row per entry of a comma-separated column, blanks dropped."""
    value = F.trim(F.col("_item"))
    return (
        df.select(key, F.explode(F.split(F.col(col), r",\s*")).alias("_item"))
        .select(key, (F.initcap(value) if initcap else value).alias(out))
        .filter(F.col(out) != "")
    )


def replace_bridge(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Every incoming key loses all its target rows and gets the incoming ones."""
    kept = filtered_by(target, incoming, key, "left_anti")
    return kept.select(*target.columns).unionByName(incoming.select(*target.columns))
