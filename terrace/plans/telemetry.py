"""Run telemetry tables and their queries."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The telemetry schemas.
RUN_SCHEMA = """
    pipeline_run_id string, pipeline_name string, batch_id string, execution_mode string,
    start_time timestamp, end_time timestamp, execution_duration_ms long, execution_status string,
    execution_host string, spark_application_id string, watermark_timestamp timestamp,
    rows_read long, rows_inserted long, rows_updated long, rows_skipped long, rows_rejected long,
    error_details string
"""
STEP_SCHEMA = """
    pipeline_run_id string, pipeline_stage string, start_time timestamp, end_time timestamp,
    execution_duration_ms long, execution_status string, records_read long, records_written long,
    records_inserted long, records_updated long, records_deleted long, records_rejected long,
    duplicate_count long, validation_failures long, error_message string
"""
DATASET_SCHEMA = """
    pipeline_run_id string, dataset_name string, storage_format string, destination_path string,
    record_count long, schema_definition string, updated_at timestamp
"""


def record(spark: SparkSession, path: str, schema: str, *entries: Mapping[str, Any]) -> None:
    """Append telemetry rows; fields not given are NULL."""
    template = spark.createDataFrame([], schema)
    rows = [tuple(entry.get(c) for c in template.columns) for entry in entries]
    spark.createDataFrame(rows, template.schema).coalesce(1).write.mode("append").parquet(path)


def describe_dataset(spark: SparkSession, path: str, name: str, run_id: str, now: datetime) -> dict[str, Any]:
    """A stored table's row count (from its file footers) and schema."""
    stored = spark.read.parquet(path)
    return {
        "pipeline_run_id": run_id,
        "dataset_name": name,
        "storage_format": "PARQUET",
        "destination_path": path,
        "record_count": stored.count(),
        "schema_definition": stored.schema.json(),
        "updated_at": now,
    }


def describe_datasets(stored: Mapping[str, tuple[str, DataFrame]], run_id: str, now: datetime) -> list[dict[str, Any]]:
    """One entry per stored table (name: path and frame), all counted in one job from file footers."""
    if not stored:
        return []
    counted = reduce(DataFrame.unionAll, (df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, (_, df) in stored.items()))
    rows = {r["name"]: r["n"] for r in counted.collect()}
    return [
        {
            "pipeline_run_id": run_id, "dataset_name": name, "storage_format": "PARQUET", "destination_path": path,
            "record_count": rows[name], "schema_definition": df.schema.json(), "updated_at": now,
        }
        for name, (path, df) in stored.items()
    ]


def latest_success(runs: DataFrame, start: str = "start_time", status: str = "execution_status", tie: str = "pipeline_run_id") -> DataFrame:
    """T4: the most recent successful run."""
    return runs.filter(F.col(status) == "SUCCESS").orderBy(F.desc(start), tie).limit(1)


def failed_runs(runs: DataFrame, start: str = "start_time", status: str = "execution_status") -> DataFrame:
    """T5: failed runs, newest first."""
    return runs.filter(F.col(status) == "FAILED").orderBy(F.desc(start))


def duration_trend(runs: DataFrame, start: str = "start_time") -> DataFrame:
    """T5: all runs, oldest first."""
    return runs.orderBy(start)


def stage_totals(steps: DataFrame, measures: Mapping[str, str], run: str = "pipeline_run_id", stage: str = "pipeline_stage") -> DataFrame:
    """Summed measures per run and stage; ``measures`` maps output to input column."""
    return steps.groupBy(run, stage).agg(*(F.sum(col).alias(out) for out, col in measures.items()))


def failures_by_stage(steps: DataFrame, stage: str = "pipeline_stage", status: str = "execution_status") -> DataFrame:
    """Failed steps per stage, most first."""
    failed = steps.filter(F.col(status) == "FAILED")
    return failed.groupBy(stage).agg(F.count("*").alias("failure_count")).orderBy(F.desc("failure_count"), stage)


def daily_history(runs: DataFrame, steps: DataFrame) -> DataFrame:
    """Batches, runs and records written per day.

    Steps are summed per run before the join, so each run meets one row and
    both distinct counts come from one pass over the runs.
    """
    written = steps.groupBy("pipeline_run_id").agg(F.sum("records_written").alias("_written"))
    joined = runs.join(written, "pipeline_run_id").withColumn("process_date", F.to_date("start_time"))
    return joined.groupBy("process_date").agg(
        F.count_distinct("batch_id").alias("batches_run"),
        F.count_distinct("pipeline_run_id").alias("runs_completed"),
        F.sum("_written").alias("daily_records_written"),
    )
