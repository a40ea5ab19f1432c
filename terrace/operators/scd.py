"""Slowly changing dimensions.

Both merges take ``source`` with any number of rows per key (see
``order``) and return the complete new table as one lazy frame. Target and
incoming rows meet in one full outer join, each read once, and an action says
what becomes of every pair; adaptive execution splits hot keys. Where the
incoming rows are estimated and counted to be few they are broadcast instead and the
target is not shuffled; the new keys are then found by a second look at the target's
key columns alone. Keys are compared null-safely: a NULL key is a key like
any other, so replaying a batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.predicates import any_changed
from terrace.operators.tables import is_small, latest_by_key

# Fixed value: the open end of a current version.
HIGH_DATE = date(9999, 12, 31)

# Merge order for a source known to hold one row per key.
UNIQUE = ("unique",)

# The columns of a version.
VERSION_COLUMNS = [
    "effective_start_date",
    "effective_end_date",
    "is_current",
    "version_number",
    "record_created_timestamp",
    "record_updated_timestamp",
]


def one_per_key(source: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """The incoming row kept for each key: first in ``order``, ties settled by the whole row.

    ``order=UNIQUE`` says the source has one row per key already.
    """
    if order == UNIQUE:
        return source
    order = list(order or [])
    tie = [F.col(c).asc_nulls_last() for c in source.columns if c not in keys]
    return latest_by_key(source, keys, order + tie)


def _same_key(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"tgt.{k}").eqNullSafe(F.col(f"src.{k}"))
    return cond


def _paired(target: DataFrame, incoming: DataFrame, keys: Sequence[str], small: bool | None) -> DataFrame:
    """Every target row beside the incoming row of its key, and the incoming rows of new keys: structs ``tgt`` and ``src``."""
    both = _same_key(keys)
    old = target.select(F.struct(*target.columns).alias("_tgt"), *keys).alias("tgt")
    new = incoming.select(F.struct(*incoming.columns).alias("_src"), *keys).alias("src")
    pair = [F.col("tgt._tgt").alias("tgt"), F.col("src._src").alias("src")]
    if not (is_small(incoming) if small is None else small):
        return old.join(new, both, "full").select(*pair)
    known = target.select(*keys).alias("tgt").join(F.broadcast(incoming.select(*keys)).alias("src"), both, "left_semi").distinct().alias("tgt")
    fresh = new.join(F.broadcast(known), both, "left_anti").select(F.lit(None).cast(target.schema).alias("tgt"), F.col("src._src").alias("src"))
    return old.join(F.broadcast(new), both, "left").select(*pair).unionByName(fresh)


# --- type 1 -------------------------------------------------------------------------------------


def scd1_actions(
    target: DataFrame, source: DataFrame, keys: Sequence[str], compare: Sequence[str], order: Sequence[Column] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """The merged table plus ``_action``: inserted, updated, unchanged or untouched.

    Changed rows take every incoming column, audit columns too; rows whose
    compared columns are equal keep the target's audit columns. ``small``
    overrides the measured choice of the join.
    """
    columns = target.columns
    paired = _paired(target, one_per_key(source, keys, order).select(*columns), keys, small)
    action = (
        F.when(F.col("tgt").isNull(), F.lit("inserted"))
        .when(F.col("src").isNull(), F.lit("untouched"))
        .when(any_changed("tgt", "src", [c for c in compare if c in columns]), F.lit("updated"))
        .otherwise(F.lit("unchanged"))
    )
    merged = F.when(F.col("_action").isin("inserted", "updated"), F.col("src")).otherwise(F.col("tgt"))
    return paired.withColumn("_action", action).select(merged.alias("_row"), "_action").select("_row.*", "_action")


def scd1_merge(
    target: DataFrame | None, source: DataFrame, keys: Sequence[str], compare: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """Insert new keys, overwrite changed ones, keep the rest; without a target it is the initial load."""
    if target is None:
        return one_per_key(source, keys, order)
    return scd1_actions(target, source, keys, compare, order).drop("_action")


# --- type 2 -------------------------------------------------------------------------------------


def _first_version(df: DataFrame, as_of: date, now: datetime) -> DataFrame:
    return df.withColumns(
        {
            "effective_start_date": F.lit(as_of),
            "effective_end_date": F.lit(HIGH_DATE),
            "is_current": F.lit(True),
            "version_number": F.lit(1),
            "record_created_timestamp": F.lit(now).cast("timestamp"),
            "record_updated_timestamp": F.lit(now).cast("timestamp"),
        }
    )


def scd2_initial(source: DataFrame, keys: Sequence[str], as_of: date, now: datetime, order: Sequence[Column] | None = None) -> DataFrame:
    """C4: every key at version 1, open until the high date."""
    return _first_version(one_per_key(source, keys, order), as_of, now)


def _version_rows(base: Sequence[str], as_of: date, now: datetime):
    """Builders of the rows a pair of target and source turns into."""
    stamp = F.lit(now).cast("timestamp")

    def row(action: Column, side: str, **version: Column) -> Column:
        fields = [F.col(f"{side}.{c}").alias(c) for c in base]
        fields += [version.get(c, F.col(f"tgt.{c}")).alias(c) for c in VERSION_COLUMNS]
        return F.struct(*fields, action.alias("_action"))

    closed = row(
        F.lit("expired"),
        "tgt",
        effective_end_date=F.date_sub(F.lit(as_of), 1),
        is_current=F.lit(False),
        record_updated_timestamp=stamp,
    )
    opened = row(
        F.lit("new_version"),
        "src",
        effective_start_date=F.lit(as_of),
        effective_end_date=F.lit(HIGH_DATE),
        is_current=F.lit(True),
        version_number=F.col("tgt.version_number") + 1,
        record_updated_timestamp=stamp,
    )
    first = row(
        F.lit("inserted"),
        "src",
        effective_start_date=F.lit(as_of),
        effective_end_date=F.lit(HIGH_DATE),
        is_current=F.lit(True),
        version_number=F.lit(1),
        record_created_timestamp=stamp,
        record_updated_timestamp=stamp,
    )
    return row, closed, opened, first


def _base_columns(target: DataFrame) -> list[str]:
    return [c for c in target.columns if c not in VERSION_COLUMNS]


def scd2_actions(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    as_of: date,
    now: datetime,
    order: Sequence[Column] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """The merged history plus ``_action``: history, untouched, unchanged, expired, new_version or inserted.

    A changed current row is closed the day before ``as_of`` and followed by
    version + 1, which carries the creation time over. A key that has closed
    versions only stays closed. ``small`` overrides the measured choice of the join.
    """
    base = _base_columns(target)
    paired = _paired(target, one_per_key(source, keys, order).select(*base), keys, small)
    row, closed, opened, first = _version_rows(base, as_of, now)
    current = F.coalesce(F.col("tgt.is_current"), F.lit(False))
    changed = current & F.col("src").isNotNull() & any_changed("tgt", "src", [c for c in compare if c in base])
    action = F.when(~current, F.lit("history")).when(F.col("src").isNull(), F.lit("untouched")).otherwise(F.lit("unchanged"))
    rows = F.when(F.col("tgt").isNull(), F.array(first)).when(changed, F.array(closed, opened)).otherwise(F.array(row(action, "tgt")))
    return paired.select(F.inline(rows)).select(*target.columns, "_action")


def scd2_changes(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    as_of: date,
    now: datetime,
    order: Sequence[Column] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Only the rows a merge writes (expired, new_version, inserted), for rewriting touched partitions."""
    actions = scd2_actions(target, source, keys, compare, as_of, now, order, small)
    return actions.filter(F.col("_action").isin("expired", "new_version", "inserted"))


def has_versions(df: DataFrame) -> bool:
    return "is_current" in df.columns and "version_number" in df.columns


def scd2_merge(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    as_of: date,
    now: datetime,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Merge; a missing target, or one without version columns, means the initial load."""
    if target is None or not has_versions(target):
        return scd2_initial(source, keys, as_of, now, order)
    return scd2_actions(target, source, keys, compare, as_of, now, order).drop("_action")


# --- reading the history ------------------------------------------------------------------------


def merge_stats(actions: DataFrame) -> DataFrame:
    """Rows per merge action."""
    return actions.groupBy(F.col("_action").alias("action")).agg(F.count("*").alias("row_count"))


def current_view(history: DataFrame) -> DataFrame:
    """The current version of every key."""
    return history.filter(F.col("is_current"))


def as_of_view(history: DataFrame, day: date) -> DataFrame:
    """The version valid on a day; versions closed before they began never match."""
    return history.filter((F.col("effective_start_date") <= F.lit(day)) & (F.col("effective_end_date") >= F.lit(day)))


def version_history(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All versions in key and version order."""
    return history.orderBy(*keys, "version_number")


def version_audit(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A10: versions, highest version and active versions per key."""
    return history.groupBy(*keys).agg(
        F.count("*").alias("versions"),
        F.max("version_number").alias("max_version"),
        F.count_if(F.col("is_current")).alias("active_versions"),
    )


def next_versions(source: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The version number each incoming key would get: one more than its highest, or 1."""
    highest = history.groupBy(*keys).agg(F.max("version_number").alias("_highest"))
    joined = source.select(*keys).join(highest, list(keys), "left")
    return joined.select(*keys, (F.coalesce("_highest", F.lit(0)) + 1).alias("next_version"))
