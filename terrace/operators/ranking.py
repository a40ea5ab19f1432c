"""Ranks, running totals, growth and top-N."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions.ratios import round_to
from terrace.session import workspace


def top_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, out: str) -> DataFrame:
    """Rows whose dense rank within the group is at most ``n`` (ties are kept)."""
    rank = F.dense_rank().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(out, rank).filter(F.col(out) <= n)


def global_rank(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """``row_number`` over the whole frame without gathering it in one task.

    The frame is range-partitioned and sorted on ``order`` and written to the
    shared folder with each row's slice and place in the slice. Only the row
    count of each slice (as many as there are shuffle partitions) is summed
    into offsets. ``order`` should end in a unique column: it makes the rank
    deterministic and lets a run of equal values split over slices.
    """
    spark = df.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{workspace(spark)}/ranked-{uuid.uuid4().hex}"
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    (
        df.repartitionByRange(slices, *order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_slice"), place.alias("_place"))
        .write.parquet(path)
    )
    ranked = spark.read.parquet(path)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranked.groupBy("_slice")
        .agg(F.count("*").alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per shuffle partition, so the broadcast is bounded by configuration, not by data.
    return ranked.join(F.broadcast(offsets), "_slice").select(
        *df.columns, (F.col("_offset") + F.col("_place") + 1).alias(out)
    )


def _sliced(df: DataFrame, order: str, measure: str) -> tuple[DataFrame, DataFrame]:
    """The frame in range-partitioned slices, written once, and what each slice takes over from those before it.

    Equal order values lie in one slice. Per slice, and so as many as there are shuffle partitions, the sum before it and the
    last measure before it (of equal order values the greatest measure is last) are put together on the driver.
    """
    spark = df.sparkSession
    path = f"{workspace(spark)}/sliced-{uuid.uuid4().hex}"
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(slices, order).withColumn("_slice", F.spark_partition_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    per_slice = stored.groupBy("_slice").agg(F.sum(measure).alias("_sum"), F.max(F.struct(order, measure))[measure].alias("_last"))
    rows, before, last = sorted(per_slice.collect()), None, None
    taken = []
    for row in rows:
        taken.append((row["_slice"], before, last))
        before = row["_sum"] if before is None else before if row["_sum"] is None else before + row["_sum"]
        last = row["_last"]
    types = {c: per_slice.schema[c].dataType.simpleString() for c in ("_sum", "_last")}
    return stored, spark.createDataFrame(taken, f"_slice int, _before {types['_sum']}, _carried {types['_last']}")


def running_total(df: DataFrame, order: str, measure: str, out: str, bounded: bool = False) -> DataFrame:
    """Sum of the measure over all rows up to each row's ``order`` value; equal values share their total.

    Slices of the order are summed apart and take over the sum before them, so no task sees all rows. With ``bounded`` the caller
    vouches for few rows, such as one per year, and one window does.
    """
    if bounded:
        return df.withColumn(out, F.sum(measure).over(Window.orderBy(order)))
    stored, taken = _sliced(df, order, measure)
    own = F.sum(measure).over(Window.partitionBy("_slice").orderBy(order))
    joined = stored.withColumn("_own", own).join(F.broadcast(taken), "_slice")
    return joined.select(*df.columns, F.coalesce(F.col("_own") + F.col("_before"), "_own", "_before").alias(out))


def growth(df: DataFrame, order: str, measure: str, out: str, digits: int = 2, bounded: bool = False) -> DataFrame:
    """Change against the previous row in percent; the first row is 0. Rows of equal order value follow by their measure.

    Slices of the order take over the last measure before them, so no task sees all rows; ``bounded`` as for W3.
    """
    current = F.col(measure).cast("double")

    def change(before: Column) -> Column:
        previous = F.coalesce(before.cast("double"), current)
        return round_to(F.try_divide((current - previous) * 100.0, previous), digits)

    if bounded:
        return df.withColumn(out, change(F.lag(measure).over(Window.orderBy(order, measure))))
    stored, taken = _sliced(df, order, measure)
    within = Window.partitionBy("_slice").orderBy(order, measure)
    placed = stored.withColumns({"_first": F.row_number().over(within) == 1, "_lag": F.lag(measure).over(within)})
    joined = placed.join(F.broadcast(taken), "_slice")
    return joined.select(*df.columns, change(F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_lag"))).alias(out))


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of a report; each task keeps only its own first ``n``."""
    return df.orderBy(*order).limit(n)


def yearly_series(df: DataFrame, x: str, y: str) -> DataFrame:
    """Chart series summed per x and sorted by it."""
    return df.groupBy(x).agg(F.sum(y).alias(y)).orderBy(x)
