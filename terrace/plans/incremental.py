"""High-water-mark loads from bronze to gold.

Silver and gold are tables of one versioned lake. A run reads and rewrites the buckets that its delta touches and becomes
visible, watermark included, in one commit; a FULL run makes a new version of every table from all of bronze.
"""

from __future__ import annotations

import math
import socket
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrace.functions import text
from terrace.functions.predicates import newer_than
from terrace.operators import quality, scd, tables
from terrace.plans import gold as gold_layer
from terrace.plans import silver as silver_layer
from terrace.plans import telemetry
from terrace.plans.gold import BY_SHOW, TITLES
from terrace.sources import sinks
from terrace.sources.snapshots import Change, Lake

# Names older bronze writers used, and the first watermark.
LEGACY_NAMES = {
    "_batch_id": "batch_id",
    "_ingested_at": "ingestion_timestamp",
    "_source_path": "source_file",
    "_load_type": "load_type",
}
EPOCH = datetime(1970, 1, 1)
WATERMARK_SCHEMA = """
    pipeline_name string, last_processed_timestamp timestamp, last_successful_batch string,
    last_business_key string, last_run_time_ms long, updated_at timestamp
"""
# The compared columns. Derived columns depend on the as-of year, so a new year alone is no change.
COMPARE = ["type", "title", "date_added", "release_year", "rating", "duration", "description"]


@dataclass(frozen=True)
class Layout:
    """Where the layers live. ``bronze`` lists the landed source tables.

    ``bucket_rows`` titles share a bucket when the lake is built, in ``buckets`` at least: a title of a delta rewrites one
    bucket, so its cost does not grow with the lake.
    """

    bronze: Sequence[str]
    root: str
    name: str = "catalog"
    bucket_rows: int = 50_000
    buckets: int = 1

    def lake(self, spark: SparkSession) -> Lake:
        """Silver and gold tables, versioned together."""
        return Lake(spark, f"{self.root}/lake")

    def read(self, spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
        """A silver or gold table as of the newest version."""
        return self.lake(spark).read(table, version)

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejected"

    @property
    def unparsed(self) -> str:
        return f"{self.root}/transformation_rejects"

    def metadata(self, table: str) -> str:
        return f"{self.root}/metadata/{table}"


@dataclass(frozen=True)
class RunMetrics:
    """What a run did; ``inserted`` counts new keys and new versions."""

    status: str
    processed: int = 0
    passed: int = 0
    rejected: int = 0
    duplicates: int = 0
    failed_dates: int = 0
    nulls_handled: int = 0
    inserted: int = 0
    updated: int = 0
    watermark: datetime = EPOCH


# --- watermarks ---------------------------------------------------------------------------------


def watermark_state(log: DataFrame) -> DataFrame:
    """The latest entry of each pipeline from the append-only watermark log."""
    return tables.latest_by_key(log, ["pipeline_name"], [F.desc("updated_at"), F.desc("last_processed_timestamp")])


def read_watermark(spark: SparkSession, path: str, pipeline: str) -> datetime:
    """The pipeline's high-water mark, or the epoch when there is none."""
    if not sinks.table_exists(spark, path):
        return EPOCH
    row = watermark_state(spark.read.parquet(path)).filter(F.col("pipeline_name") == pipeline).first()
    return row["last_processed_timestamp"] if row else EPOCH


def commit_watermark(spark: SparkSession, path: str, entry: Mapping[str, Any]) -> None:
    """Append the new mark. An append is atomic, so a crash leaves the old mark in force."""
    telemetry.record(spark, path, WATERMARK_SCHEMA, entry)


def next_watermark(df: DataFrame, ts: str, watermark: datetime) -> DataFrame:
    """Rows after the mark and the mark that follows, as one row."""
    return newer_than(df, ts, watermark).agg(F.count("*").alias("delta_rows"), F.max(ts).alias("next_watermark"))


# --- consolidation ------------------------------------------------------------------------------


def consolidate(frames: Sequence[DataFrame], run_id: str, how: str = "intersect") -> DataFrame:
    """Bronze sources under one set of names and types."""
    ready = [
        tables.harmonize(
            tables.ensure_columns(
                tables.normalize_names(df, LEGACY_NAMES),
                {"pipeline_run_id": F.lit(run_id), "source_system": F.lit("JSON_INGEST")},
            ),
            {"release_year": "string"},
        )
        for df in frames
    ]
    return tables.union_sources(ready, how)


# --- touched-partition merges -------------------------------------------------------------------


def apply_scd2(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], compare: Sequence[str],
    as_of: date, now: datetime, partition_by: str, order: Sequence | None = None,
) -> dict[str, int]:
    """Merge into a stored history, rewriting only the partitions rows leave or enter."""
    sinks.recover(spark, path)
    target = spark.read.parquet(path) if sinks.table_exists(spark, path) else None
    # The incoming rows meet the target three times, so they are reduced to one per key once.
    source = sinks.stage(scd.one_per_key(source, keys, order), "incoming")
    if target is None or not scd.has_versions(target):
        first = scd.scd2_initial(source, keys, as_of, now, scd.UNIQUE)
        inserted = source.count()
        if inserted:  # an empty partitioned table would have no files and so no schema
            sinks.replace_table(first, path, [partition_by])
        return {"inserted": inserted, "expired": 0, "new_version": 0}

    changes = sinks.stage(scd.scd2_changes(target, source, keys, compare, as_of, now, scd.UNIQUE), "changes")
    # One row per action and touched partition directory: metadata-sized, and a literal list prunes the scan.
    written = changes.groupBy("_action", partition_by).agg(F.count("*").alias("n")).collect()
    stats = {a: sum(r["n"] for r in written if r["_action"] == a) for a in ("inserted", "expired", "new_version")}
    if not written:
        return stats
    closed = changes.filter(F.col("_action") == "expired").select(*keys, "version_number")
    touched = {r[partition_by] for r in written}
    where = F.col(partition_by).isin([v for v in touched if v is not None])
    if None in touched:
        where = where | F.col(partition_by).isNull()
    kept = target.filter(where).join(tables.by_rows(closed), [*keys, "version_number"], "left_anti").select(*target.columns)
    sinks.replace_partitions(kept.unionByName(changes.drop("_action")), path, [partition_by])
    return stats


# --- touched-bucket merges ----------------------------------------------------------------------


def merge_titles(change: Change, incoming: DataFrame, compare: Sequence[str], as_of: date, now: datetime) -> dict[str, int]:
    """Merge one row per title into the stored history; only buckets in which a version changes are rewritten."""
    target = change.before(TITLES, change.touched(TITLES, incoming))
    merged = scd.scd2_changes(target, incoming, ["show_id"], compare, as_of, now, scd.UNIQUE)
    changes = sinks.stage(merged, "changes")
    found = {r["_action"]: r["n"] for r in changes.groupBy("_action").agg(F.count("*").alias("n")).collect()}
    if found:
        buckets = change.touched(TITLES, changes)
        closed = changes.filter(F.col("_action") == "expired")

        def rows(some: Sequence[int]) -> DataFrame:
            kept = tables.matching(change.before(TITLES, some), change.within(TITLES, closed, some), ["show_id", "version_number"], "left_anti")
            return kept.unionByName(change.within(TITLES, changes.drop("_action"), some))

        change.rewrite_sliced(TITLES, rows, buckets)
    return {a: found.get(a, 0) for a in ("inserted", "expired", "new_version")}


def merge_bridge(change: Change, name: str, incoming: DataFrame) -> None:
    """The incoming titles lose their rows in a stored bridge and get the incoming ones; their buckets are rewritten."""

    def rows(some: Sequence[int]) -> DataFrame:
        ours = change.within(name, incoming, some)
        return tables.matching(change.before(name, some), ours, ["show_id"], "left_anti").unionByName(ours)

    change.rewrite_sliced(name, rows, change.touched(name, incoming))


def _part(change: Change, keys: DataFrame, buckets: Sequence[int], of: Callable) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Current versions and bridge rows of some titles, before the change or after it, written once."""
    jobs = {TITLES: scd.current_view(of(TITLES, buckets)), **{b: of(b, buckets) for b in silver_layer.BRIDGES if b != "silver_cast"}}
    done = sinks.run_together(partial(sinks.stage, tables.matching(df, keys, ["show_id"]), name) for name, df in jobs.items())
    found = dict(zip(jobs, done, strict=True))
    return found.pop(TITLES), found


# --- the run ------------------------------------------------------------------------------------


class Steps:
    """Timed steps of one run, appended to the telemetry table together."""

    def __init__(self, run_id: str) -> None:
        self.run_id = run_id
        self.rows: list[dict[str, Any]] = []

    def timed(self, stage: str, job: Callable[[], Any]) -> Any:
        """Run a step; a step that raises is kept as FAILED with its message."""
        start, failure = datetime.now(), None
        try:
            return job()
        except Exception as err:
            failure = str(err)
            raise
        finally:
            end = datetime.now()
            self.rows.append(
                {
                    "pipeline_run_id": self.run_id, "pipeline_stage": stage, "start_time": start, "end_time": end,
                    "execution_duration_ms": int((end - start).total_seconds() * 1000),
                    "execution_status": "FAILED" if failure is not None else "SUCCESS", "error_message": failure,
                }
            )

    def note(self, stage: str, **counts: Any) -> None:
        for row in self.rows:
            if row["pipeline_stage"] == stage:
                row.update(counts)


def _judge(delta: DataFrame, rules: quality.Rules | None, run_id: str) -> tuple[DataFrame, dict[str, Any]]:
    """The delta with reject reasons, and its counts and next watermark; judged rows are written once."""
    judged = quality.with_reasons(delta, rules) if rules else delta.withColumn("reasons", F.array().cast("array<string>"))
    nulls = sum((F.count_if(F.col(c).isNull()) for c in silver_layer.TEXT_COLUMNS), F.lit(0))
    counts = (
        F.count("*").alias("processed"),
        F.count_if(F.size("reasons") > 0).alias("rejected"),
        nulls.alias("nulls_handled"),
        F.max("ingestion_timestamp").alias("watermark"),
    )
    if not rules:  # nothing is worked out per row, so the rows are counted where they lie and not written once more
        return judged, judged.agg(*counts).first().asDict()
    seen = Observation(f"delta-{run_id}")
    return sinks.stage(judged.observe(seen, *counts), "judged"), seen.get


def _clean(passed: DataFrame, as_of: date, order: Sequence | None, run_id: str) -> tuple[silver_layer.Silver, dict[str, Any]]:
    """Silver frames over cleaned rows written once, with the counts of kept rows and bad dates."""
    seen = Observation(f"cleaned-{run_id}")
    bad_date = text.unparsed(F.col("date_added"), F.col("parsed_date"))

    def persist(cleaned: DataFrame) -> DataFrame:
        counts = (F.count("*").alias("kept"), F.count_if(bad_date).alias("failed_dates"))
        return sinks.stage(cleaned.observe(seen, *counts), "cleaned")

    return silver_layer.build_silver(passed, as_of.year, order=order, persist=persist), seen.get


def _rebuild(change: Change, built: silver_layer.Silver, steps: Steps, layout: Layout, rows: int, batch_id: str, run_id: str, as_of: date, now: datetime) -> dict[str, int]:
    """Every silver and gold table anew from the rows of a FULL load; keys it does not hold are gone."""
    buckets = max(math.ceil(rows / layout.bucket_rows), layout.buckets)
    first = scd.scd2_initial(built.titles, ["show_id"], as_of, now, scd.UNIQUE)
    bridges = [partial(change.replace, n, df, BY_SHOW, buckets) for n, df in built.bridges.items()]
    sinks.run_together(
        [
            lambda: steps.timed("SCD_Type2", lambda: change.replace(TITLES, first, BY_SHOW, buckets)),
            lambda: steps.timed("SCD_Type1", lambda: sinks.run_together(bridges)),
        ]
    )
    stored = {b: change.read(b) for b in silver_layer.BRIDGES}
    steps.timed("Gold", lambda: gold_layer.rebuild(change, scd.current_view(change.read(TITLES)), stored, batch_id, run_id, buckets))
    return {"inserted": rows, "expired": 0, "new_version": 0}


def _refresh(change: Change, built: silver_layer.Silver, steps: Steps, compare: Sequence[str], batch_id: str, run_id: str, as_of: date, now: datetime) -> dict[str, int]:
    """Merge a delta into silver and take its difference over into gold, touched buckets only."""
    bridges = [partial(merge_bridge, change, n, df) for n, df in built.bridges.items()]
    stats, _ = sinks.run_together(
        [
            lambda: steps.timed("SCD_Type2", lambda: merge_titles(change, built.titles, compare, as_of, now)),
            lambda: steps.timed("SCD_Type1", lambda: sinks.run_together(bridges)),
        ]
    )

    def gold() -> None:
        keys = built.titles.select("show_id")
        buckets = change.touched(TITLES, keys)
        old, new = (_part(change, keys, buckets, of) for of in (change.before, change.read))
        gold_layer.refresh(change, keys, old, new, batch_id, run_id)

    steps.timed("Gold", gold)
    return stats


def apply_rows(
    change: Change, rows: DataFrame, layout: Layout, steps: Steps, batch_id: str, run_id: str, as_of: date, now: datetime,
    full: bool, rules: quality.Rules | None, gate: bool, compare: Sequence[str], order: Sequence | None,
) -> RunMetrics:
    """Bronze rows through rules, cleaning and merges into a change of the lake; what fails is quarantined under the batch."""
    judged, counted = steps.timed("Validation", lambda: _judge(rows, rules, run_id))
    bad = F.size("reasons") > 0
    spark = rows.sparkSession
    if counted["rejected"]:
        rejected = judged.filter(bad).withColumn("reason_for_failure", F.concat_ws(", ", "reasons"))
        sinks.write_rejects(rejected, layout.rejects, batch_id, now)
    passed = (judged.filter(~bad) if gate else judged).drop("reasons")
    built, cleaned = steps.timed("Silver_Cleansing", lambda: _clean(passed, as_of, order, run_id))
    if cleaned["failed_dates"]:
        sinks.write_rejects(built.rejects, layout.unparsed, batch_id, now)
    written = cleaned["kept"] - cleaned["failed_dates"]
    if full or TITLES not in change:
        merged = _rebuild(change, built, steps, layout, written, batch_id, run_id, as_of, now)
    elif written:
        merged = _refresh(change, built, steps, compare, batch_id, run_id, as_of, now)
    else:
        merged = {"inserted": 0, "expired": 0, "new_version": 0}

    taken = counted["processed"] - (counted["rejected"] if gate else 0)
    result = RunMetrics(
        "SUCCESS",
        processed=counted["processed"],
        passed=counted["processed"] - counted["rejected"],
        rejected=counted["rejected"],
        duplicates=taken - cleaned["kept"],
        failed_dates=cleaned["failed_dates"],
        nulls_handled=counted["nulls_handled"],
        inserted=merged["inserted"] + merged["new_version"],
        updated=merged["expired"],
        watermark=counted["watermark"],
    )
    steps.note("Validation", records_read=result.processed, records_written=taken, records_rejected=result.rejected)
    steps.note(
        "Silver_Cleansing", records_read=taken, records_written=written,
        duplicate_count=result.duplicates, validation_failures=result.failed_dates,
    )
    steps.note("SCD_Type1", records_read=written)
    steps.note("SCD_Type2", records_read=written, records_inserted=result.inserted, records_updated=result.updated)
    return result


def _load(
    spark: SparkSession, layout: Layout, steps: Steps, batch_id: str, run_id: str, as_of: date, now: datetime,
    full: bool, rules: quality.Rules | None, gate: bool, compare: Sequence[str], order: Sequence | None,
) -> RunMetrics:
    change = layout.lake(spark).begin()
    bronze = consolidate([spark.read.parquet(p) for p in layout.bronze], run_id)
    kept = change.state.get(f"watermark {layout.name}")
    mark = EPOCH if full or kept is None else datetime.fromisoformat(kept)
    day = "ingestion_date" if "ingestion_date" in bronze.columns else None
    delta = bronze if full else newer_than(bronze, "ingestion_timestamp", mark, day)
    if delta.isEmpty():
        return RunMetrics("SKIPPED", watermark=mark)
    result = apply_rows(change, delta, layout, steps, batch_id, run_id, as_of, now, full, rules, gate, compare, order)
    if result.watermark is not None:
        change.state[f"watermark {layout.name}"] = result.watermark.isoformat()
    change.commit()
    return result


def run_pipeline(
    spark: SparkSession,
    layout: Layout,
    *,
    batch_id: str,
    run_id: str,
    as_of: date,
    now: datetime,
    full: bool = False,
    rules: quality.Rules | None = None,
    gate: bool = True,
    compare: Sequence[str] = COMPARE,
    order: Sequence | None = None,
) -> RunMetrics:
    """I4: bronze delta to silver, SCD tables, star, telemetry and watermark.

    All tables and the watermark change in one commit, so a run that dies
    before it leaves the lake as it was and is simply run again; a run
    without new rows changes no table. ``full`` takes all of bronze and
    overwrites every layer. ``gate=False`` lets rows that break the rules
    through to silver.
    """
    started = datetime.now()
    steps = Steps(run_id)
    run = {
        "pipeline_run_id": run_id, "pipeline_name": layout.name, "batch_id": batch_id, "start_time": now,
        "execution_mode": "FULL" if full else "INCREMENTAL", "execution_host": socket.gethostname(),
        "spark_application_id": spark.sparkContext.applicationId,
    }

    def close(status: str, **more: Any) -> int:
        elapsed = int((datetime.now() - started).total_seconds() * 1000)
        row = {**run, "execution_status": status, "execution_duration_ms": elapsed, "end_time": now + timedelta(milliseconds=elapsed), **more}
        telemetry.record(spark, layout.metadata("pipeline_runs"), telemetry.RUN_SCHEMA, row)
        if steps.rows:
            telemetry.record(spark, layout.metadata("pipeline_steps"), telemetry.STEP_SCHEMA, *steps.rows)
        return elapsed

    try:
        with sinks.freeing(spark):
            result = _load(spark, layout, steps, batch_id, run_id, as_of, now, full, rules, gate, compare, order)
    except Exception as err:
        close("FAILED", error_details=str(err))
        raise
    if result.status == "SKIPPED":
        close("SKIPPED", watermark_timestamp=result.watermark)
        return result

    stored = layout.lake(spark)
    described = telemetry.describe_datasets({n: (f"{stored.root}/data/{n}", stored.frame(t)) for n, t in stored.snapshot().tables.items()}, run_id, now)
    telemetry.record(spark, layout.metadata("dataset_metadata"), telemetry.DATASET_SCHEMA, *described)
    stored.vacuum()
    elapsed = close(
        "SUCCESS", watermark_timestamp=result.watermark, rows_read=result.processed, rows_inserted=result.inserted,
        rows_updated=result.updated, rows_skipped=result.duplicates, rows_rejected=result.rejected,
    )
    commit_watermark(spark, layout.metadata("watermarks"), {
        "pipeline_name": layout.name, "last_processed_timestamp": result.watermark, "last_successful_batch": batch_id,
        "last_business_key": "show_id", "last_run_time_ms": elapsed, "updated_at": now,
    })
    return result
