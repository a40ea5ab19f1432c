"""Cleaning, parsing, labels, filters and list columns (P and F)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from suite import lake
from suite.lake import over_clean, over_raw, over_silver, rounded, table
from suite.registry import query
from terrace.functions import calendar, labels, predicates, ratios, text
from terrace.operators import ranking, rollups
from terrace.operators.tables import labelled_union, stamp_audit
from terrace.plans import silver as silver_layer
from terrace.plans.incremental import consolidate

NOW = datetime(2024, 2, 1, 12, 0, 0)


@query(
    """
SELECT event_id, ts, user_id, event_type, value, props, 'batch-7' AS batch_id, 'run-7' AS pipeline_run_id,
       TIMESTAMP '2024-02-01 12:00:00' AS ingestion_timestamp, 'clickstream' AS source_system, 'events.json' AS source_file,
       'INCREMENTAL' AS load_type, DATE '2024-02-01' AS ingestion_date
FROM events"""
)
def audit_stamped_events(spark, sf):
    stamped = stamp_audit(
        table(spark, sf, "events"), batch_id="batch-7", run_id="run-7", source_system="clickstream",
        source_file="events.json", load_type="incremental", now=NOW,
    )
    return stamped.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz"))


@query(
    """
SELECT 'o' || o_orderkey AS record_id, CAST(year(o_orderdate) AS VARCHAR) AS release_year, 'b1' AS batch_id,
       'run-9' AS pipeline_run_id, 'JSON_INGEST' AS source_system FROM orders
UNION ALL
SELECT 'e' || event_id, CAST(year(ts) AS VARCHAR), 'b2', 'run-3', 'clickstream' FROM events"""
)
def consolidated_sources(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.concat(F.lit("o"), "o_orderkey").alias("record_id"), F.year("o_orderdate").alias("release_year"),
        F.lit("b1").alias("_batch_id"), "o_totalprice",
    )
    events = table(spark, sf, "events").select(
        "user_id", F.concat(F.lit("e"), "event_id").alias("record_id"), F.year("ts").cast("string").alias("release_year"),
        F.lit("b2").alias("batch_id"), F.lit("run-3").alias("pipeline_run_id"), F.lit("clickstream").alias("source_system"),
    )
    return consolidate([orders, events], "run-9")


@query(r"SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS text_md5, length(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS text_length FROM documents")
def squashed_documents(spark, sf):
    tidy = table(spark, sf, "documents").select("doc_id", text.squash_space(F.col("text")).alias("t"))
    return tidy.select("doc_id", F.md5("t").alias("text_md5"), F.length("t").cast("long").alias("text_length"))


@query(over_clean("SELECT * FROM cleaned"))
def cleaned_catalog(spark, sf):
    raw = lake.bronze(spark, sf)
    unique = silver_layer.latest_by_key(raw, ["show_id"], silver_layer.newest_first(raw))
    return silver_layer.clean(unique).select(*silver_layer.RAW_COLUMNS, "parsed_date")


@query(over_silver("SELECT * FROM silver_titles"))
def silver_titles(spark, sf):
    return lake.titles(spark, sf).drop("batch_id", "pipeline_run_id", "ingestion_timestamp")


@query(
    over_silver(
        """
SELECT 'silver_country' AS bridge, show_id, country AS value FROM silver_country
UNION ALL SELECT 'silver_genres', * FROM silver_genres
UNION ALL SELECT 'silver_directors', * FROM silver_directors
UNION ALL SELECT 'silver_cast', * FROM silver_cast"""
    )
)
def silver_bridges(spark, sf):
    bridges = lake.bridges(spark, sf)
    return labelled_union(
        {n: df.select("show_id", F.col(silver_layer.BRIDGES[n][1]).alias("value")) for n, df in bridges.items()}, "bridge"
    )


@query(
    over_clean(
        "SELECT show_id, date_added, 'Unparseable date_added format' AS reason_for_failure FROM cleaned "
        "WHERE parsed_date IS NULL AND date_added IS NOT NULL AND trim(date_added) <> ''"
    )
)
def date_rejects(spark, sf):
    built = silver_layer.build_silver(lake.bronze(spark, sf), lake.AS_OF_YEAR)
    return built.rejects.select("show_id", "date_added", "reason_for_failure")


@query(
    over_raw(
        """,
u AS (SELECT DISTINCT * FROM raw)
SELECT (SELECT count(*) FROM raw) AS records_received,
       (SELECT count(*) FROM raw) - count(*) AS duplicates_removed,
       CAST(sum((title IS NULL)::INT + (director IS NULL)::INT + ("cast" IS NULL)::INT + (country IS NULL)::INT
           + (duration IS NULL)::INT + (listed_in IS NULL)::INT + (description IS NULL)::INT) AS BIGINT) AS nulls_handled,
       count(*) FILTER (date_added IS NOT NULL AND trim(date_added) <> '' AND try_strptime(date_added, '%B %-d, %Y') IS NULL) AS failed_dates_count,
       count(*) FILTER (date_added IS NULL OR trim(date_added) = '' OR try_strptime(date_added, '%B %-d, %Y') IS NOT NULL) AS records_written
FROM u"""
    )
)
def silver_load_metrics(spark, sf):
    return silver_layer.silver_metrics(lake.bronze(spark, sf))


@query(over_clean("SELECT show_id, duration, CAST(TRY_CAST(split_part(duration, ' ', 1) AS INTEGER) AS INTEGER) AS amount FROM cleaned"))
def leading_numbers(spark, sf):
    raw = lake.bronze(spark, sf)
    unique = silver_layer.latest_by_key(raw, ["show_id"], silver_layer.newest_first(raw))
    return silver_layer.clean(unique).select("show_id", "duration", text.leading_int(F.col("duration")).alias("amount"))


@query(
    """
SELECT size_band, price_class, count(*) AS parts FROM (
  SELECT CASE WHEN p_size < 15 THEN 'small' WHEN p_size < 35 THEN 'medium' ELSE 'large' END AS size_band,
         CASE WHEN p_retailprice >= 1000 THEN 'premium' ELSE 'standard' END AS price_class
  FROM part) GROUP BY size_band, price_class"""
)
def part_size_bands(spark, sf):
    size = F.col("p_size")
    tagged = table(spark, sf, "part").select(
        labels.bands(size, labels.below(size, (15, "small"), (35, "medium")), "large").alias("size_band"),
        labels.two_way(F.col("p_retailprice") >= 1000, "premium", "standard").alias("price_class"),
    )
    return rollups.count_by(tagged, ["size_band", "price_class"], "parts")


@query(
    """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
       CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week,
       CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, count(*) AS orders
FROM orders GROUP BY ALL"""
)
def order_calendar(spark, sf):
    day = F.col("o_orderdate")
    dated = table(spark, sf, "orders").select(
        *(c.alias(n) for n, c in calendar.calendar_columns(day).items()), calendar.date_key(day).alias("date_key")
    )
    return rollups.count_by(dated, dated.columns, "orders")


@query(
    over_silver(
        """
SELECT type, CAST(floor(avg(duration_minutes) / 60) AS INTEGER) AS hours,
       CAST(round_even(avg(duration_minutes) % 60, 0) AS INTEGER) AS minutes
FROM silver_titles WHERE duration_minutes IS NOT NULL GROUP BY type"""
    )
)
def typical_runtime(spark, sf):
    avg = lake.titles(spark, sf).filter("duration_minutes IS NOT NULL").groupBy("type").agg(F.avg("duration_minutes").alias("m"))
    hours, minutes = ratios.split_minutes(F.col("m"))
    return avg.select("type", hours.alias("hours"), minutes.alias("minutes"))


@query(
    """
SELECT l_returnflag, l_linestatus, count(*) AS lines,
       """
    + rounded("100.0 * count(*)::DOUBLE / (SELECT count(*) FROM lineitem)::DOUBLE", 2)
    + """ AS percentage_share
FROM lineitem GROUP BY l_returnflag, l_linestatus"""
)
def line_status_shares(spark, sf):
    counted = rollups.count_by(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "lines")
    return rollups.share_of_total(counted, "lines")


@query(over_silver("SELECT release_year, count(*) AS titles FROM silver_titles GROUP BY release_year"))
def chart_series_by_year(spark, sf):
    per_type = rollups.count_by(lake.titles(spark, sf), ["release_year", "type"], "titles")
    return ranking.yearly_series(per_type, "release_year", "titles")


@query(
    over_silver(
        "SELECT country, count(*) AS titles FROM silver_country GROUP BY country ORDER BY titles DESC, country LIMIT 10"
    )
)
def chart_top_countries(spark, sf):
    counted = rollups.count_by(lake.bridges(spark, sf)["silver_country"], ["country"], "titles")
    return ranking.top_n(counted, [F.desc("titles"), F.asc("country")], 10)


# --- filters ------------------------------------------------------------------------------------


@query("SELECT event_id, ts, event_type FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'")
def events_after_watermark(spark, sf):
    return predicates.newer_than(table(spark, sf, "events"), "ts", datetime(2024, 1, 15)).select("event_id", "ts", "event_type")


@query(
    """
SELECT lang, count(*) AS documents, count(*) FILTER (n_chars BETWEEN 500 AND 5000) AS mid_length,
       count(*) FILTER (source LIKE 'src1%') AS from_src1,
       count(*) FILTER (regexp_matches(source, '^src[0-9]$')) AS single_digit_source
FROM documents WHERE lang IS NOT NULL AND lang NOT IN ('fr', 'de') GROUP BY lang"""
)
def document_predicates(spark, sf):
    df = table(spark, sf, "documents").select("lang", "n_chars", "source")
    outside = df.filter(predicates.not_in_set(F.col("lang"), ["fr", "de"]))
    return outside.groupBy("lang").agg(
        F.count("*").alias("documents"),
        F.count_if(F.col("n_chars").between(500, 5000)).alias("mid_length"),
        F.count_if(F.col("source").like("src1%")).alias("from_src1"),
        F.count_if(F.col("source").rlike("^src[0-9]$")).alias("single_digit_source"),
    )


@query(
    """
SELECT o_custkey, count(*) AS urgent_orders FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 0
GROUP BY o_custkey HAVING count(*) >= 3"""
)
def frequent_urgent_customers(spark, sf):
    urgent = table(spark, sf, "orders").filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 0))
    return rollups.count_by(urgent, ["o_custkey"], "urgent_orders").filter(F.col("urgent_orders") >= 3)
