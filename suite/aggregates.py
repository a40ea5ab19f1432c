"""Aggregates, joins at the right grain, top-N and table audits (A, J, T, U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite import lake
from suite.lake import over_fact, over_raw, over_silver, rounded, table
from suite.registry import query
from terrace.functions import text
from terrace.operators import ranking, rollups
from terrace.plans import silver as silver_layer

AMOUNT = "TRY_CAST(split_part(duration, ' ', 1) AS INTEGER)"


@query(
    over_silver(
        f"""
SELECT type, count(*) AS n, {rounded(f"avg({AMOUNT})", 2)} AS avg_value, min({AMOUNT}) AS min_value, max({AMOUNT}) AS max_value
FROM silver_titles WHERE (type = 'Movie' AND duration LIKE '%min%') OR (type = 'TV Show' AND duration LIKE '%Season%')
GROUP BY type"""
    )
)
def duration_stats(spark, sf):
    t = F.col("type")
    unit = ((t == "Movie") & F.col("duration").like("%min%")) | ((t == "TV Show") & F.col("duration").like("%Season%"))
    return rollups.parsed_stats(lake.titles(spark, sf).filter(unit), text.leading_int(F.col("duration")), ["type"])


@query(
    over_silver(
        f"""
SELECT type, count(*) AS total_rows, count(duration_minutes) AS with_value, count(*) - count(duration_minutes) AS missing_value,
       CAST(sum(duration_minutes) AS BIGINT) AS value_sum, {rounded("avg(duration_minutes)", 1)} AS avg_rounded
FROM silver_titles GROUP BY type"""
    )
)
def duration_denominators(spark, sf):
    return rollups.denominator_audit(lake.titles(spark, sf), F.col("duration_minutes"), ["type"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def repeated_order_lines(spark, sf):
    return rollups.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(over_fact("SELECT CAST(sum(n) AS BIGINT) AS assignment_total FROM (SELECT country, count(DISTINCT show_id) AS n FROM fact GROUP BY country)"))
def country_assignments(spark, sf):
    return rollups.assignment_total(lake.star(spark, sf).fact, "country_key", "title_key")


def _factor(rows: str, keys: str) -> str:
    return rounded(f"({rows})::DOUBLE / ({keys})::DOUBLE", 3)


@query(
    over_fact(
        f"""
SELECT 'silver_titles' AS table_name, count(*) AS total_rows, count(DISTINCT show_id) AS distinct_keys, {_factor("count(*)", "count(DISTINCT show_id)")} AS duplication_factor FROM silver_titles
UNION ALL SELECT 'silver_country', count(*), count(DISTINCT show_id), {_factor("count(*)", "count(DISTINCT show_id)")} FROM silver_country
UNION ALL SELECT 'fact_content', count(*), count(DISTINCT show_id), {_factor("count(*)", "count(DISTINCT show_id)")} FROM fact
UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_orderkey), {_factor("count(*)", "count(DISTINCT l_orderkey)")} FROM lineitem"""
    )
)
def grain_report(spark, sf):
    return rollups.grain_audit(
        {
            "silver_titles": (lake.titles(spark, sf), "show_id"),
            "silver_country": (lake.bridges(spark, sf)["silver_country"], "show_id"),
            "fact_content": (lake.star(spark, sf).fact, "title_key"),
            "lineitem": (table(spark, sf, "lineitem"), "l_orderkey"),
        }
    )


@query(
    over_raw(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER (\"{c}\" IS NULL) AS null_count FROM raw" for c in silver_layer.RAW_COLUMNS
        )
        + ")"
    )
)
def catalog_null_counts(spark, sf):
    return rollups.null_counts(lake.bronze(spark, sf), silver_layer.RAW_COLUMNS)


COUNTED = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
]


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in COUNTED))
def table_row_counts(spark, sf):
    return rollups.row_counts({t: table(spark, sf, t) for t in COUNTED})


@query(over_silver("SELECT rating, type, count(*) AS titles FROM silver_titles GROUP BY rating, type"))
def rating_by_type(spark, sf):
    return rollups.count_by(lake.titles(spark, sf), ["rating", "type"], "titles")


@query(
    over_silver(
        f"SELECT title, duration, release_year FROM silver_titles WHERE type = 'Movie' AND duration LIKE '%min%' "
        f"ORDER BY {AMOUNT} DESC, title LIMIT 10"
    )
)
def longest_movies(spark, sf):
    movies = lake.titles(spark, sf).filter((F.col("type") == "Movie") & F.col("duration").like("%min%"))
    top = ranking.top_n(movies, [text.leading_int(F.col("duration")).desc(), F.asc("title")], 10)
    return top.select("title", "duration", "release_year")


@query(
    over_silver(
        f"SELECT title, duration, release_year FROM silver_titles WHERE type = 'Movie' AND duration LIKE '%min%' "
        f"AND {AMOUNT} > 0 ORDER BY {AMOUNT}, title LIMIT 1"
    )
)
def shortest_movie(spark, sf):
    minutes = text.leading_int(F.col("duration"))
    movies = lake.titles(spark, sf).filter((F.col("type") == "Movie") & F.col("duration").like("%min%") & (minutes > 0))
    return ranking.top_n(movies, [minutes.asc(), F.asc("title")], 1).select("title", "duration", "release_year")


@query(
    over_silver(
        f"SELECT title, duration, release_year FROM silver_titles WHERE type = 'TV Show' AND duration LIKE '%Season%' "
        f"ORDER BY {AMOUNT} DESC, title LIMIT 1"
    )
)
def most_seasons(spark, sf):
    shows = lake.titles(spark, sf).filter((F.col("type") == "TV Show") & F.col("duration").like("%Season%"))
    return ranking.top_n(shows, [text.leading_int(F.col("duration")).desc(), F.asc("title")], 1).select("title", "duration", "release_year")


@query(
    over_fact(
        f"""
SELECT (SELECT {rounded("avg(duration_minutes)", 1)} FROM fact) AS fact_grain,
       (SELECT {rounded("avg(duration_minutes)", 1)} FROM (SELECT DISTINCT show_id, duration_minutes FROM fact)) AS title_grain"""
    )
)
def duration_by_grain(spark, sf):
    from terrace.functions.ratios import round_to

    fact = lake.star(spark, sf).fact
    at_title = rollups.grain_average(fact, "title_key", "duration_minutes", "v").scalar()
    return fact.agg(round_to(F.avg("duration_minutes"), 1).alias("fact_grain")).withColumn("title_grain", at_title)


@query(
    """
SELECT s_suppkey, s_name, parts, lines,
       row_number() OVER (ORDER BY lines DESC, s_suppkey) AS supplier_rank
FROM (SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(*) AS lines FROM lineitem GROUP BY l_suppkey)
JOIN supplier ON l_suppkey = s_suppkey"""
)
def supplier_ranking(spark, sf):
    per_part = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"))
    volume = per_part.groupBy("l_suppkey").agg(F.count("*").alias("parts"), F.sum("n").alias("lines"))
    named = volume.join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return ranking.global_rank(named.select("s_suppkey", "s_name", "parts", "lines"), [F.desc("lines"), F.asc("s_suppkey")], "supplier_rank")


@query(
    """
SELECT * FROM (
  SELECT n_name, p_type, count(*) AS lines,
         CAST(dense_rank() OVER (PARTITION BY n_name ORDER BY count(*) DESC) AS INTEGER) AS type_rank
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
  GROUP BY n_name, p_type)
WHERE type_rank <= 3"""
)
def top_part_types_by_nation(spark, sf):
    # Lines are counted per (supplier, part) before any dimension is joined.
    pairs = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"))
    named = (
        pairs.join(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf, "nation").select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    counted = named.groupBy("n_name", "p_type").agg(F.sum("n").alias("lines"))
    return ranking.top_n_per_group(counted, ["n_name"], [F.desc("lines")], 3, "type_rank")


@query(
    f"""
SELECT year, orders, CAST(sum(orders) OVER (ORDER BY year) AS BIGINT) AS running_orders,
       {rounded("(orders - coalesce(lag(orders) OVER (ORDER BY year), orders))::DOUBLE * 100.0 / coalesce(lag(orders) OVER (ORDER BY year), orders)::DOUBLE", 2)} AS growth_pct
FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders FROM orders GROUP BY 1)"""
)
def order_growth(spark, sf):
    yearly = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("orders"))
    return ranking.growth(ranking.running_total(yearly, "year", "orders", "running_orders", bounded=True), "year", "orders", "growth_pct", bounded=True)


@query("SELECT l_orderkey, l_linenumber, CAST(sum(l_linenumber) OVER (ORDER BY l_shipdate) AS BIGINT) AS lines_so_far FROM lineitem")
def running_lines(spark, sf):
    """A running total over every line, in slices of the ship dates."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return ranking.running_total(lines, "l_shipdate", "l_linenumber", "lines_so_far").select("l_orderkey", "l_linenumber", "lines_so_far")


SPEND = "SELECT user_id, event_id, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"


@query(
    f"""
SELECT event_id, {rounded("CASE WHEN before <> 0 THEN (k - before)::DOUBLE * 100.0 / before::DOUBLE END", 2)} AS growth_pct
FROM (SELECT event_id, k, coalesce(lag(k) OVER (ORDER BY ts, k), k) AS before FROM ({SPEND}))"""
)
def event_growth(spark, sf):
    """Change from event to event over the whole stream, in slices of the timestamps."""
    events = table(spark, sf, "events").select("event_id", "ts", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return ranking.growth(events, "ts", "k", "growth_pct").select("event_id", "growth_pct")
