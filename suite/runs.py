"""Telemetry queries, with every event standing for one run and one step."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.lake import table
from suite.registry import query
from terrace.plans import telemetry

RUNS = """
runs AS (
  SELECT 'r' || event_id AS pipeline_run_id, 'p' || (user_id % 10) AS pipeline_name, 'b' || user_id AS batch_id, ts AS start_time,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS execution_duration_ms,
         CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' ELSE 'SKIPPED' END AS execution_status
  FROM events),
steps AS (
  SELECT 'r' || event_id AS pipeline_run_id, event_type AS pipeline_stage, CAST(json_extract_string(props, '$.k') AS BIGINT) AS records_read,
         CAST(json_extract_string(props, '$.k') AS BIGINT) * 2 AS records_written,
         CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' ELSE 'SKIPPED' END AS execution_status
  FROM events)"""


def _status():
    kind = F.col("event_type")
    return F.when(kind == "purchase", "SUCCESS").when(kind == "error", "FAILED").otherwise("SKIPPED").alias("execution_status")


def _k():
    return F.get_json_object("props", "$.k").cast("long")


def _runs(spark, sf):
    return table(spark, sf, "events").select(
        F.concat(F.lit("r"), "event_id").alias("pipeline_run_id"),
        F.concat(F.lit("p"), F.col("user_id") % 10).alias("pipeline_name"),
        F.concat(F.lit("b"), "user_id").alias("batch_id"),
        F.col("ts").alias("start_time"),
        _k().alias("execution_duration_ms"),
        _status(),
    )


def _steps(spark, sf):
    return table(spark, sf, "events").select(
        F.concat(F.lit("r"), "event_id").alias("pipeline_run_id"),
        F.col("event_type").alias("pipeline_stage"),
        _k().alias("records_read"),
        (_k() * 2).alias("records_written"),
        _status(),
    )


@query(f"WITH {RUNS} SELECT * FROM runs WHERE execution_status = 'SUCCESS' ORDER BY start_time DESC, pipeline_run_id LIMIT 1")
def latest_successful_run(spark, sf):
    return telemetry.latest_success(_runs(spark, sf))


@query(f"WITH {RUNS} SELECT * FROM runs WHERE execution_status = 'FAILED'")
def failed_runs(spark, sf):
    return telemetry.failed_runs(_runs(spark, sf))


@query(f"WITH {RUNS} SELECT * FROM runs")
def run_duration_trend(spark, sf):
    return telemetry.duration_trend(_runs(spark, sf))


@query(
    """
SELECT user_id, event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total_read, count(*) AS steps
FROM events GROUP BY user_id, event_type"""
)
def stage_totals(spark, sf):
    steps = table(spark, sf, "events").select("user_id", "event_type", _k().alias("k"), F.lit(1).alias("one"))
    return telemetry.stage_totals(steps, {"total_read": "k", "steps": "one"}, "user_id", "event_type")


@query(f"WITH {RUNS} SELECT pipeline_stage, count(*) AS failure_count FROM steps WHERE execution_status = 'FAILED' GROUP BY pipeline_stage")
def failures_by_stage(spark, sf):
    return telemetry.failures_by_stage(_steps(spark, sf))


@query(
    f"""WITH {RUNS}
SELECT CAST(start_time AS DATE) AS process_date, count(DISTINCT batch_id) AS batches_run, count(DISTINCT pipeline_run_id) AS runs_completed,
       CAST(sum(records_written) AS BIGINT) AS daily_records_written
FROM runs JOIN steps USING (pipeline_run_id) GROUP BY CAST(start_time AS DATE)"""
)
def daily_run_history(spark, sf):
    return telemetry.daily_history(_runs(spark, sf), _steps(spark, sf))
