"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.tables import FEW, looks_small
from terrace.session import workspace


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str | Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; NULL for a NULL key."""
    return F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")) % modulus


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder that the cluster names in ``spark.checkpoint.dir``."""
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def freeing(spark: SparkSession) -> Iterator[list[str]]:
    """Delete what is staged inside the block when it ends; paths that are taken from the list stay."""
    paths: list[str] = []
    token = _staged.set(paths)
    try:
        yield paths
    finally:
        _staged.reset(token)
        for path in paths:
            discard(spark, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    if (paths := _staged.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, through whatever file system holds it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def finite(vector: Column) -> Column:
    """Whether an array<double> is there and holds neither NULL nor NaN nor infinity."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def floored(vector: Column, scale: int = 256) -> Column:
    """array<bigint> of floor(scale * component); beyond the range of long its nearest end."""
    return F.transform(vector, lambda c: F.floor(c * F.lit(float(scale))))


def integer_vectors(vectors: DataFrame, key: str, vector: str, scale: int = 256) -> DataFrame:
    """``id`` and ``x`` (floored vector), one row per id, of rows with an id and a finite vector; of several the greatest."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    kept = rows.where(F.col("id").isNotNull() & finite(F.col("v"))).select("id", floored(F.col("v"), scale).alias("x"))
    return kept.groupBy("id").agg(F.max("x").alias("x"))


BROADCAST_BYTES = 64 << 20


def measured(df: DataFrame) -> int:
    """Bytes of a frame's rows, as JSON text."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, size: int, most: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a side of few measured bytes; beyond that Spark shuffles both sides."""
    return F.broadcast(df) if size <= most else df


def salted_left_join(left: DataFrame, right: DataFrame, key: str, spread_by: str, salts: int = 16) -> DataFrame:
    """Left join on ``key`` where single keys may hold much of ``left``.

    ``right`` has one row per key and is repeated ``salts`` times; a hot key's rows go to ``salts`` tasks. Spark estimates the
    copies as one, by the compressed files below them; where that is low, rows are counted and many are merged, not broadcast.
    """
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    if looks_small(right) and right.count() > FEW // salts:
        copies = copies.hint("merge")
    return left.withColumn("_salt", salt).join(copies, [key, "_salt"], "left").drop("_salt")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores put before it until no column of ``df`` has it (names differ by more than case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def text_runs(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 22) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches with at most ``most`` bytes of text each (or one row), and their texts."""
    for batch in batches:
        col = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(col), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > most:
                yield batch.slice(start, i - start), col.slice(start, i - start).to_pylist()
                start, total = i, 0
            total += n
        if start < len(sizes):
            yield batch.slice(start), col.slice(start).to_pylist()


def with_text_columns(docs: DataFrame, text: str, fields: dict[str, str], start: Callable[[], Callable[[list], list[pa.Array]]]) -> DataFrame:
    """All columns of ``docs`` and those of ``fields`` (name: type), computed from whole texts.

    ``start`` is called once per task and returns a function from texts to one array per new column.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for part, texts in text_runs(batches, text):
            yield pa.record_batch([*part.columns, *compute(texts)], names=[*part.schema.names, *fields])

    shape = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(run, ", ".join([*shape, *(f"`{n}` {t}" for n, t in fields.items())]))
