"""Parquet sinks (S9-S12, S17). Writers take frames and paths; all work is on executors."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.session import workspace


# Beside a table: replacements that are written but not yet swapped in. The marker is what commits one.
PENDING = "__pending"
COMMITTED = "_COMMITTED"


def filesystem(spark: SparkSession, path: str):
    """The Hadoop path and the file system that holds it."""
    sc = spark.sparkContext
    location = sc._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(sc._jsc.hadoopConfiguration())


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished write is stored at ``path``; a folder that a dying write left behind is no table."""
    marker, fs = filesystem(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of derived data, if it is there."""
    location, fs = filesystem(spark, path)
    fs.delete(location, True)


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Put the folder ``source`` in the place of ``target``. Repeating it after a crash gives the same state."""
    location, fs = filesystem(spark, target)
    fs.delete(location, True)
    fs.mkdirs(location.getParent())
    if not fs.rename(filesystem(spark, source)[0], location):
        raise OSError(f"cannot move {source} to {target}")


def _swap(spark: SparkSession, pending: str, path: str) -> None:
    """Bring a committed replacement into place: the whole table, or its partition directories one by one."""
    whole, fs = filesystem(spark, f"{pending}/table")
    if fs.exists(whole):
        _move(spark, f"{pending}/table", path)
    parts, _ = filesystem(spark, f"{pending}/partitions")
    if fs.exists(parts):
        leaves = {f.getPath().getParent() for f in _files(fs, parts) if not f.getPath().getName().startswith(("_", "."))}
        for leaf in sorted(leaves, key=str):
            inside = leaf.toUri().getPath()[len(parts.toUri().getPath()) + 1 :]
            _move(spark, f"{pending}/partitions/{inside}", f"{path}/{inside}")
    discard(spark, pending)


def _files(fs, location) -> list:
    found, listing = [], fs.listFiles(location, True)
    while listing.hasNext():
        found.append(listing.next())
    return found


def recover(spark: SparkSession, path: str) -> None:
    """Finish the committed replacements of a table that a crash interrupted, and drop those never committed."""
    pending, fs = filesystem(spark, f"{path}{PENDING}")
    if not fs.exists(pending):
        return
    for found in sorted((f.getPath() for f in fs.listStatus(pending)), key=str):
        marker, _ = filesystem(spark, f"{found}/{COMMITTED}")
        if fs.exists(marker):
            _swap(spark, str(found), path)
        else:
            discard(spark, str(found))


def _replace(spark: SparkSession, path: str, kind: str, write: Callable[[str], None]) -> None:
    """Write a replacement beside the table, commit it by one marker file, and swap it in."""
    recover(spark, path)
    pending = f"{path}{PENDING}/{uuid.uuid4().hex}"
    write(f"{pending}/{kind}")
    marker, fs = filesystem(spark, f"{pending}/{COMMITTED}")
    fs.create(marker).close()
    _swap(spark, pending, path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Write, by partition directory if asked.

    Rows are first rebalanced on the partition columns: small partitions
    share a task and a hot one is split over several, so neither tiny files
    nor one giant task result.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def run_together(jobs: Iterable[Callable[[], object]], width: int = 4) -> list:
    """Run independent Spark actions side by side, so one job's last tasks do not idle the cluster."""
    in_session = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(width) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, in_session(job)) for job in jobs]]


def write_bronze(df: DataFrame, path: str, load_type: str) -> None:
    """FULL replaces the table by a committed swap, INCREMENTAL appends to it. One load has one date, so no shuffle is needed."""
    if load_type.upper() == "FULL":
        _replace(df.sparkSession, path, "table", lambda at: df.write.partitionBy("ingestion_date").parquet(at))
    elif load_type.upper() == "INCREMENTAL":
        recover(df.sparkSession, path)
        df.write.mode("append").partitionBy("ingestion_date").parquet(path)
    else:
        raise KeyError(load_type)


_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside the block an action's shuffle files go when it ends, not when the driver happens to collect its garbage.

    So the disk holds those of the running actions, however many came before. The session's own setting holds again afterwards.
    """
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside the block when it ends, and shuffle files with their action; nothing may read them afterwards."""
    paths: list[str] = []
    token = _staged.set(paths)
    try:
        with short_shuffles(spark):
            yield
    finally:
        _staged.reset(token)
        for path in paths:
            discard(spark, path)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives executor loss."""
    spark = df.sparkSession
    path = f"{workspace(spark)}/{name}-{uuid.uuid4().hex}"
    if (paths := _staged.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table by a frame that may read it.

    The new content is written once, beside the table, and then moved into
    its place. A crash leaves either the old table or a committed replacement
    that ``recover`` finishes.
    """
    _replace(df.sparkSession, path, "table", lambda at: write_table(df, at, "overwrite", partition_by))


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``; the others are not touched.

    All new partitions are written before the first one is moved, so a crash
    in between is finished by ``recover``.
    """
    _replace(df.sparkSession, path, "partitions", lambda at: write_table(df, at, "overwrite", partition_by))


def partition_counts(spark: SparkSession, path: str, partition_by: str) -> DataFrame:
    """Rows per partition directory of a written table."""
    return spark.read.parquet(path).groupBy(partition_by).agg(F.count("*").alias("row_count"))


def write_rejects(rejected: DataFrame, root: str, batch_id: str, now) -> str:
    """Quarantine one batch in its own directory; the reasons stay queryable."""
    path = f"{root.rstrip('/')}/rejected_batch_{batch_id}"
    stamped = rejected.withColumns({"validation_timestamp": F.lit(now).cast("timestamp"), "batch_id": F.lit(batch_id)})
    stamped.write.mode("overwrite").parquet(path)
    return path
