"""Slowly changing dimensions, incremental runs and the continuous load (C, I)."""

from __future__ import annotations

import math
import uuid
from datetime import date, datetime
from functools import cache

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from suite import lake
from suite.checks import JUDGED, RULES
from suite.lake import over_clean, over_fact, over_raw, over_silver, table
from suite.registry import query
from terrace.operators import scd
from terrace.operators.tables import labelled_union
from terrace.plans import gold, incremental
from terrace.plans.silver import BRIDGES
from terrace.session import workspace
from terrace.sources import sinks
from terrace.streaming import continuous

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)
FILE_ROWS = 250_000  # a streamed file holds about so many, so one task writes no third of the input
KEYS, COMPARE = ["c_custkey"], ["c_mktsegment", "c_acctbal"]


def _target(spark, sf):
    return table(spark, sf, "customer").withColumn("batch_id", F.lit("b1"))


def _incoming(spark, sf):
    """Customers with orders, those with an urgent one moved to a new segment, and the suppliers as new keys."""
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    known = table(spark, sf, "customer").join(per_customer, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal",
        F.when(F.col("urgent"), "PRIORITY").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    new = table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 10000000).alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"), F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    return known.unionByName(new).withColumn("batch_id", F.lit("b2"))


def _second(spark, sf):
    """A later feed: overdrawn customers lose their balance sign."""
    return _target(spark, sf).filter("c_acctbal < 0").withColumns({"c_acctbal": F.abs("c_acctbal"), "batch_id": F.lit("b3")})


SOURCES = """
per_customer AS (SELECT o_custkey, bool_or(o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY o_custkey),
src AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN urgent THEN 'PRIORITY' ELSE c_mktsegment END AS c_mktsegment, 'b2' AS batch_id
  FROM customer JOIN per_customer ON c_custkey = o_custkey
  UNION ALL SELECT 10000000 + s_suppkey, s_name, s_nationkey, s_acctbal, 'SUPPLIER', 'b2' FROM supplier),
tgt AS (SELECT *, 'b1' AS batch_id FROM customer),
changed AS (SELECT src.c_custkey FROM src JOIN tgt USING (c_custkey)
  WHERE src.c_mktsegment IS DISTINCT FROM tgt.c_mktsegment OR src.c_acctbal IS DISTINCT FROM tgt.c_acctbal)"""
COLS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, batch_id"


@query(
    f"""WITH {SOURCES}
SELECT {COLS} FROM tgt WHERE c_custkey NOT IN (SELECT c_custkey FROM changed)
UNION ALL SELECT {COLS} FROM src WHERE c_custkey IN (SELECT c_custkey FROM changed) OR c_custkey NOT IN (SELECT c_custkey FROM tgt)"""
)
def scd1_customers(spark, sf):
    return scd.scd1_merge(_target(spark, sf), _incoming(spark, sf), KEYS, COMPARE)


@query(
    f"""WITH {SOURCES}
SELECT 'inserted' AS action, count(*) AS row_count FROM src WHERE c_custkey NOT IN (SELECT c_custkey FROM tgt)
UNION ALL SELECT 'updated', count(*) FROM changed
UNION ALL SELECT 'unchanged', count(*) FROM src JOIN tgt USING (c_custkey) WHERE c_custkey NOT IN (SELECT c_custkey FROM changed)
UNION ALL SELECT 'untouched', count(*) FROM tgt WHERE c_custkey NOT IN (SELECT c_custkey FROM src)"""
)
def scd1_statistics(spark, sf):
    stats = scd.merge_stats(scd.scd1_actions(_target(spark, sf), _incoming(spark, sf), KEYS, COMPARE))
    actions = spark.createDataFrame([(a,) for a in ("inserted", "updated", "unchanged", "untouched")], "action string")
    return actions.join(stats, "action", "left").select("action", F.coalesce("row_count", F.lit(0)).alias("row_count"))


HISTORY = f"""{SOURCES},
h1 AS (
  SELECT {COLS}, DATE '2024-01-01' AS effective_start_date,
         CASE WHEN c_custkey IN (SELECT c_custkey FROM changed) THEN DATE '2024-01-31' ELSE DATE '9999-12-31' END AS effective_end_date,
         c_custkey NOT IN (SELECT c_custkey FROM changed) AS is_current, 1 AS version_number,
         TIMESTAMP '2024-01-01' AS record_created_timestamp,
         CASE WHEN c_custkey IN (SELECT c_custkey FROM changed) THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-01' END AS record_updated_timestamp
  FROM tgt
  UNION ALL SELECT {COLS}, DATE '2024-02-01', DATE '9999-12-31', true, 2, TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-01'
  FROM src WHERE c_custkey IN (SELECT c_custkey FROM changed)
  UNION ALL SELECT {COLS}, DATE '2024-02-01', DATE '9999-12-31', true, 1, TIMESTAMP '2024-02-01', TIMESTAMP '2024-02-01'
  FROM src WHERE c_custkey NOT IN (SELECT c_custkey FROM tgt)),
src2 AS (SELECT c_custkey, c_name, c_nationkey, abs(c_acctbal) AS c_acctbal, c_mktsegment, 'b3' AS batch_id FROM customer WHERE c_acctbal < 0),
h2 AS (
  SELECT {COLS}, effective_start_date, CASE WHEN hit THEN DATE '2024-02-29' ELSE effective_end_date END AS effective_end_date,
         is_current AND NOT hit AS is_current, version_number, record_created_timestamp,
         CASE WHEN hit THEN TIMESTAMP '2024-03-01' ELSE record_updated_timestamp END AS record_updated_timestamp
  FROM (SELECT *, is_current AND c_custkey IN (SELECT c_custkey FROM src2) AS hit FROM h1)
  UNION ALL
  SELECT s.c_custkey, s.c_name, s.c_nationkey, s.c_acctbal, s.c_mktsegment, s.batch_id, DATE '2024-03-01', DATE '9999-12-31', true,
         h.version_number + 1, h.record_created_timestamp, TIMESTAMP '2024-03-01'
  FROM src2 s JOIN h1 h USING (c_custkey) WHERE h.is_current)"""


def _ntz(df):
    return df.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("record_created_timestamp", "record_updated_timestamp")}
    )


def _history(spark, sf, merges: int = 1):
    history = scd.scd2_initial(_target(spark, sf), KEYS, T1.date(), T1)
    history = scd.scd2_merge(history, _incoming(spark, sf), KEYS, COMPARE, T2.date(), T2)
    return history if merges == 1 else scd.scd2_merge(history, _second(spark, sf), KEYS, COMPARE, T3.date(), T3)


@query(
    """
SELECT *, 'b1' AS batch_id, DATE '2024-01-01' AS effective_start_date, DATE '9999-12-31' AS effective_end_date, true AS is_current,
       1 AS version_number, TIMESTAMP '2024-01-01' AS record_created_timestamp, TIMESTAMP '2024-01-01' AS record_updated_timestamp
FROM customer"""
)
def scd2_first_load(spark, sf):
    return _ntz(scd.scd2_merge(None, _target(spark, sf), KEYS, COMPARE, T1.date(), T1))


@query(f"WITH {HISTORY} SELECT * FROM h1")
def scd2_customers(spark, sf):
    return _ntz(_history(spark, sf))


@query(f"WITH {HISTORY} SELECT * FROM h2")
def scd2_customers_twice(spark, sf):
    return _ntz(_history(spark, sf, 2))


@query(f"WITH {HISTORY} SELECT * FROM h2")
def scd2_stored_merge(spark, sf):
    """The same history kept as a table partitioned by nation, merged by rewriting touched partitions."""
    path = f"{workspace(spark)}/scd2-{uuid.uuid4().hex}"
    for feed, at in ((_target(spark, sf), T1), (_incoming(spark, sf), T2), (_second(spark, sf), T3)):
        incremental.apply_scd2(spark, path, feed, KEYS, COMPARE, at.date(), at, "c_nationkey")
    return _ntz(spark.read.parquet(path))


@query(
    f"""WITH {HISTORY}
SELECT 'history' AS action, count(*) AS row_count FROM h1 WHERE NOT is_current
UNION ALL SELECT 'expired', count(*) FROM h1 JOIN src2 USING (c_custkey) WHERE is_current
UNION ALL SELECT 'new_version', count(*) FROM h1 JOIN src2 USING (c_custkey) WHERE is_current
UNION ALL SELECT 'untouched', count(*) FROM h1 WHERE is_current AND c_custkey NOT IN (SELECT c_custkey FROM src2)"""
)
def scd2_statistics(spark, sf):
    return scd.merge_stats(scd.scd2_actions(_history(spark, sf), _second(spark, sf), KEYS, COMPARE, T3.date(), T3))


@query(f"WITH {HISTORY} SELECT {COLS}, version_number FROM h2 WHERE is_current")
def current_customers(spark, sf):
    return scd.current_view(_history(spark, sf, 2)).select(*COLS.split(", "), "version_number")


@query(f"WITH {HISTORY} SELECT {COLS}, version_number FROM h2 WHERE effective_start_date <= DATE '2024-02-15' AND effective_end_date >= DATE '2024-02-15'")
def customers_as_of(spark, sf):
    return scd.as_of_view(_history(spark, sf, 2), date(2024, 2, 15)).select(*COLS.split(", "), "version_number")


@query(
    f"""WITH {HISTORY} SELECT c_custkey, version_number, c_mktsegment, c_acctbal, effective_start_date, effective_end_date, is_current FROM h2"""
)
def customer_versions(spark, sf):
    return scd.version_history(_history(spark, sf, 2), KEYS).select(
        "c_custkey", "version_number", "c_mktsegment", "c_acctbal", "effective_start_date", "effective_end_date", "is_current"
    )


@query(
    f"""WITH {HISTORY} SELECT c_custkey, count(*) AS versions, max(version_number) AS max_version,
       count(*) FILTER (is_current) AS active_versions FROM h2 GROUP BY c_custkey"""
)
def version_audit(spark, sf):
    return scd.version_audit(_history(spark, sf, 2), KEYS)


# --- incremental --------------------------------------------------------------------------------


@query("SELECT count(*) AS delta_rows, max(ts) AS next_watermark FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'")
def next_watermark(spark, sf):
    return incremental.next_watermark(table(spark, sf, "events"), "ts", datetime(2024, 1, 15))


@query(
    """
SELECT event_type AS pipeline_name, ts AS last_processed_timestamp, 'b' || event_id AS last_successful_batch FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1"""
)
def watermark_state(spark, sf):
    log = table(spark, sf, "events").select(
        F.col("event_type").alias("pipeline_name"), F.col("ts").alias("last_processed_timestamp"),
        F.concat(F.lit("b"), "event_id").alias("last_successful_batch"), F.col("ts").alias("updated_at"),
    )
    return incremental.watermark_state(log).drop("updated_at")


@cache
def _three_runs(app: str, sf: str) -> incremental.Layout:
    """A full run, a run over re-delivered urgent titles, and a run that finds nothing new."""
    spark = SparkSession.active()
    root = f"{workspace(spark)}/pipeline-{uuid.uuid4().hex}"
    raw = lake.bronze(spark, sf)
    first, second = lake.bronze_path(spark, sf), f"{root}/bronze/second"
    start = incremental.Layout([first], root)
    incremental.run_pipeline(spark, start, batch_id="b1", run_id="r1", as_of=T1.date(), now=T1, full=True)
    raw.filter("rating = '1-URGENT'").withColumns(
        {"title": F.concat("title", F.lit("Revised")), "ingestion_timestamp": F.lit(T2).cast("timestamp"), "batch_id": F.lit("b2")}
    ).write.parquet(second)
    both = incremental.Layout([first, second], root)
    incremental.run_pipeline(spark, both, batch_id="b2", run_id="r2", as_of=T2.date(), now=T2)
    incremental.run_pipeline(spark, both, batch_id="b3", run_id="r3", as_of=T3.date(), now=T3)
    return both


def _layout(spark, sf):
    return _three_runs(spark.sparkContext.applicationId, sf)


@query(
    over_silver(
        """
SELECT show_id, title, rating, release_year, 1 AS version_number, DATE '2024-01-01' AS effective_start_date,
       CASE WHEN rating = '1-URGENT' THEN DATE '2024-01-31' ELSE DATE '9999-12-31' END AS effective_end_date, rating <> '1-URGENT' AS is_current
FROM silver_titles
UNION ALL
SELECT show_id, title || ' Revised', rating, release_year, 2, DATE '2024-02-01', DATE '9999-12-31', true
FROM silver_titles WHERE rating = '1-URGENT'"""
    )
)
def incremental_titles(spark, sf):
    return _layout(spark, sf).read(spark, "silver_titles_scd2").select(
        "show_id", "title", "rating", "release_year", "version_number", "effective_start_date", "effective_end_date", "is_current"
    )


@query(
    over_silver(
        """
SELECT 'silver_country' AS bridge, show_id, country AS value FROM silver_country
UNION ALL SELECT 'silver_genres', * FROM silver_genres
UNION ALL SELECT 'silver_directors', * FROM silver_directors
UNION ALL SELECT 'silver_cast', * FROM silver_cast"""
    )
)
def incremental_bridges(spark, sf):
    """Re-delivered titles replace their bridge rows, so the bridges are as after one clean load."""
    layout = _layout(spark, sf)
    return labelled_union(
        {n: layout.read(spark, n).select("show_id", F.col(out).alias("value")) for n, (_, out, _) in BRIDGES.items()}, "bridge"
    )


@query(over_fact("SELECT release_year, count(*) AS facts, count(DISTINCT show_id) AS titles FROM fact GROUP BY release_year"))
def incremental_facts(spark, sf):
    """The star after the runs holds current versions only."""
    fact = _layout(spark, sf).read(spark, "fact_content")
    per_title = fact.groupBy("release_year", "title_key").agg(F.count("*").alias("n"))
    return per_title.groupBy("release_year").agg(F.sum("n").alias("facts"), F.count("*").alias("titles"))


@query(
    over_silver(
        """,
urgent AS (SELECT count(*) AS n FROM raw WHERE rating = '1-URGENT'),
changed AS (SELECT count(*) AS n FROM silver_titles WHERE rating = '1-URGENT'),
repeats AS (SELECT (SELECT count(*) FROM raw) - count(*) AS n FROM unique_raw),
urgent_repeats AS (SELECT (SELECT n FROM urgent) - count(*) AS n FROM unique_raw WHERE rating = '1-URGENT')
SELECT 'r1' AS pipeline_run_id, 'FULL' AS execution_mode, 'SUCCESS' AS execution_status, (SELECT count(*) FROM raw) AS rows_read,
       (SELECT count(*) FROM silver_titles) AS rows_inserted, 0 AS rows_updated, (SELECT n FROM repeats) AS rows_skipped
UNION ALL SELECT 'r2', 'INCREMENTAL', 'SUCCESS', (SELECT n FROM urgent), (SELECT n FROM changed), (SELECT n FROM changed), (SELECT n FROM urgent_repeats)
UNION ALL SELECT 'r3', 'INCREMENTAL', 'SKIPPED', NULL, NULL, NULL, NULL"""
    )
)
def incremental_run_log(spark, sf):
    return spark.read.parquet(_layout(spark, sf).metadata("pipeline_runs")).select(
        "pipeline_run_id", "execution_mode", "execution_status", "rows_read", "rows_inserted", "rows_updated", "rows_skipped"
    )


@query(
    f"""WITH {HISTORY},
latest AS (SELECT c_custkey, max(version_number) AS v FROM h2 GROUP BY c_custkey)
SELECT src.c_custkey, coalesce(v, 0) + 1 AS next_version FROM
 (SELECT c_custkey FROM src UNION SELECT s_suppkey + 20000000 FROM supplier) src LEFT JOIN latest USING (c_custkey)"""
)
def next_versions(spark, sf):
    unseen = table(spark, sf, "supplier").select((F.col("s_suppkey") + 20000000).alias("c_custkey"))
    feed = _incoming(spark, sf).select("c_custkey").union(unseen)
    return scd.next_versions(feed, _history(spark, sf, 2), KEYS)


@cache
def _gated_run(app: str, sf: str) -> incremental.Layout:
    """One full run whose rules keep bad rows out of silver."""
    spark = SparkSession.active()
    root = f"{workspace(spark)}/gated-{uuid.uuid4().hex}"
    lake.bronze(spark, sf)
    layout = incremental.Layout([lake.bronze_path(spark, sf)], root)
    incremental.run_pipeline(spark, layout, batch_id="b1", run_id="r1", as_of=T1.date(), now=T1, full=True, rules=RULES)
    return layout


@query(over_raw(JUDGED + "SELECT show_id, title, array_to_string(reasons, ', ') AS reason_for_failure, 'b1' AS batch_id FROM judged WHERE len(reasons) > 0"))
def quarantined_records(spark, sf):
    """What a gated run put into quarantine, read back."""
    layout = _gated_run(spark.sparkContext.applicationId, sf)
    return spark.read.parquet(f"{layout.rejects}/rejected_batch_b1").select("show_id", "title", "reason_for_failure", "batch_id")


@query(over_raw(JUDGED + "SELECT show_id FROM judged GROUP BY show_id HAVING max(len(reasons)) = 0"))
def gated_titles(spark, sf):
    """The titles that a gated run let into silver."""
    layout = _gated_run(spark.sparkContext.applicationId, sf)
    return layout.read(spark, "silver_titles_scd2").select("show_id")


@cache
def _streamed(app: str, sf: str) -> incremental.Layout:
    """The bronze files as a stream of a third of them a batch, merged into silver and gold until none is left."""
    spark = SparkSession.active()
    root = f"{workspace(spark)}/stream-{uuid.uuid4().hex}"
    raw, files = lake.bronze(spark, sf), f"{root}/bronze"
    # A title's copies lie in one file, so the batches are a partition of the titles.
    per_batch = max(math.ceil(raw.count() / (3 * FILE_ROWS)), 1)
    with sinks.short_shuffles(spark):
        raw.repartition(3 * per_batch, "show_id").write.parquet(files)
    layout = incremental.Layout([], root)
    merge = continuous.layers_merger(layout, "bronze", as_of=T1.date().replace(year=lake.AS_OF_YEAR), now=T1)
    continuous.merge_batches(spark, files, raw.schema, merge, f"{root}/checkpoint", files_per_batch=per_batch).awaitTermination()
    return layout


@query(over_silver("SELECT show_id, type, title, date_added, release_year, rating, duration, 1 AS version_number, true AS is_current FROM silver_titles"))
def streamed_history(spark, sf):
    return _streamed(spark.sparkContext.applicationId, sf).read(spark, "silver_titles_scd2").select(
        "show_id", "type", "title", "date_added", "release_year", "rating", "duration", "version_number", "is_current"
    )


@query(over_clean("SELECT show_id, title, 'Unparseable date_added format' AS reason_for_failure FROM cleaned WHERE parsed_date IS NULL AND trim(date_added) <> ''"))
def streamed_rejects(spark, sf):
    """What the stream could not read, quarantined batch by batch."""
    folder = _streamed(spark.sparkContext.applicationId, sf).unparsed
    return spark.read.option("recursiveFileLookup", "true").parquet(folder).select("show_id", "title", "reason_for_failure")


@query(over_fact("SELECT release_year, count(*) AS yearly_releases FROM fact GROUP BY release_year"))
def streamed_releases(spark, sf):
    """A KPI table that every batch of the stream kept up."""
    return _streamed(spark.sparkContext.applicationId, sf).read(spark, "kpi_release_summary")


MEMBER_SQL = {
    "director": "SELECT DISTINCT director AS member FROM silver_directors",
    "country": "SELECT DISTINCT country FROM silver_country",
    "genre": "SELECT DISTINCT genre FROM silver_genres",
    "rating": "SELECT DISTINCT rating FROM silver_titles",
    "type": "SELECT DISTINCT type FROM silver_titles",
}


@query(over_silver(" UNION ALL ".join(f"SELECT '{n}' AS dimension, * FROM ({sql}) t" for n, sql in MEMBER_SQL.items())))
def incremental_members(spark, sf):
    """Dimension members kept up by the deltas of three runs."""
    stored = gold.read_star(_layout(spark, sf).lake(spark))
    return labelled_union({n: stored.dims[f"dim_{n}"].select(F.col(n).alias("member")) for n in MEMBER_SQL}, "dimension")


KPI_SQL = {
    "country": "SELECT country AS member, count(*) AS total_content FROM fact GROUP BY 1",
    "genre": "SELECT genre, count(*) FROM fact GROUP BY 1",
    "rating": "SELECT rating, count(*) FROM fact GROUP BY 1",
}


@query(over_fact(" UNION ALL ".join(f"SELECT '{n}' AS kpi, * FROM ({sql}) t" for n, sql in KPI_SQL.items())))
def incremental_kpis(spark, sf):
    """KPI tables kept up by taking away what a delta's titles counted before and adding what they count now."""
    layout = _layout(spark, sf)
    return labelled_union({n: layout.read(spark, f"kpi_{n}_summary").select(F.col(n).alias("member"), "total_content") for n in KPI_SQL}, "kpi")


@query(
    over_fact(
        """
SELECT 'silver_titles_scd2' AS dataset_name, (SELECT count(*) + count(*) FILTER (rating = '1-URGENT') FROM silver_titles) AS record_count
UNION ALL SELECT 'silver_country', (SELECT count(*) FROM silver_country)
UNION ALL SELECT 'silver_genres', (SELECT count(*) FROM silver_genres)
UNION ALL SELECT 'silver_directors', (SELECT count(*) FROM silver_directors)
UNION ALL SELECT 'silver_cast', (SELECT count(*) FROM silver_cast)
UNION ALL SELECT 'fact_content', (SELECT count(*) FROM fact)
UNION ALL SELECT 'dim_title', (SELECT count(*) FROM silver_titles)
UNION ALL SELECT 'dim_director', (SELECT count(DISTINCT director) FROM silver_directors)
UNION ALL SELECT 'dim_country', (SELECT count(DISTINCT country) FROM silver_country)
UNION ALL SELECT 'dim_genre', (SELECT count(DISTINCT genre) FROM silver_genres)
UNION ALL SELECT 'dim_rating', (SELECT count(DISTINCT rating) FROM silver_titles)
UNION ALL SELECT 'dim_type', (SELECT count(DISTINCT type) FROM silver_titles)
UNION ALL SELECT 'dim_date', (SELECT count(DISTINCT date_added) FROM silver_titles)
UNION ALL SELECT 'kpi_content_summary', 1
UNION ALL SELECT 'kpi_country_summary', (SELECT count(DISTINCT country) FROM fact)
UNION ALL SELECT 'kpi_genre_summary', (SELECT count(DISTINCT genre) FROM fact)
UNION ALL SELECT 'kpi_rating_summary', (SELECT count(DISTINCT rating) FROM fact)
UNION ALL SELECT 'kpi_release_summary', (SELECT count(*) FROM (SELECT DISTINCT release_year FROM fact))
UNION ALL SELECT 'kpi_parts', (SELECT 1 + count(DISTINCT country) + count(DISTINCT genre) + count(DISTINCT rating) FROM fact)
                              + (SELECT count(*) FROM (SELECT DISTINCT release_year FROM fact))"""
    )
)
def stored_datasets(spark, sf):
    """Rows of every stored table, as the telemetry of the last run that changed any recorded them."""
    described = spark.read.parquet(_layout(spark, sf).metadata("dataset_metadata"))
    return described.filter("pipeline_run_id = 'r2'").select("dataset_name", "record_count")
