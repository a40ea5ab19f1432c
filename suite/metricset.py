"""Metric catalog, reconciliation and ad-hoc SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite import lake
from suite.kpis import BY_TYPE
from suite.lake import over_fact, over_silver, rounded
from suite.registry import query
from terrace.functions.ratios import round_to
from terrace.plans import adhoc, metrics, views
from terrace.plans.metrics import Metric

MOVIE, SHOW = "type = 'Movie'", "type = 'TV Show'"
LEADING = "try_cast(split_part(duration, ' ', 1) as int)"
MOVIE_MIN = "type = 'Movie' AND duration LIKE '%min%'"
SHOW_SEASON = "type = 'TV Show' AND duration LIKE '%Season%'"

CATALOG = [
    Metric("total_titles", "silver_titles", "count", "show_id", unit="titles"),
    Metric("total_movies", "silver_titles", "count", "show_id", filter=MOVIE, unit="titles"),
    Metric("total_tv_shows", "silver_titles", "count", "show_id", filter=SHOW, unit="titles"),
    Metric("movie_ratio", "silver_titles", "ratio_pct", filter=MOVIE, unit="%"),
    Metric("tv_ratio", "silver_titles", "ratio_pct", filter=SHOW, unit="%"),
    Metric("average_content_age", "silver_titles", "avg", "content_age", digits=1, unit="years"),
    Metric("average_movie_duration", "silver_titles", "avg", LEADING, filter=MOVIE_MIN, digits=1, unit="minutes"),
    Metric("min_movie_duration", "silver_titles", "min", LEADING, filter=MOVIE_MIN, unit="minutes"),
    Metric("max_movie_duration", "silver_titles", "max", LEADING, filter=MOVIE_MIN, unit="minutes"),
    Metric("average_seasons", "silver_titles", "avg", LEADING, filter=SHOW_SEASON, unit="seasons"),
    Metric("min_seasons", "silver_titles", "min", LEADING, filter=SHOW_SEASON, unit="seasons"),
    Metric("max_seasons", "silver_titles", "max", LEADING, filter=SHOW_SEASON, unit="seasons"),
    Metric("fact_titles", "fact_content", "count", "title_key", grain=("title_key", "content_age"), unit="titles"),
    Metric("fact_average_age", "fact_content", "avg", "content_age", grain=("title_key", "content_age"), digits=1, unit="years"),
    Metric("fact_rows", "fact_content", "count", "title_key", unit="rows"),
    Metric("country_assignments", "fact_content", "count", "title_key", grain=("title_key", "country_key"), unit="assignments"),
]

_A = "TRY_CAST(split_part(duration, ' ', 1) AS INTEGER)"


def _row(name: str, value: str, unit: str, source: str = "silver_titles", where: str = "true") -> str:
    return f"SELECT '{name}' AS metric, CAST({value} AS DOUBLE) AS value, '{unit}' AS unit FROM {source} WHERE {where}"


METRIC_ROWS = "\nUNION ALL ".join(
    [
        _row("total_titles", "count(*)", "titles"),
        _row("total_movies", "count(*)", "titles", where=MOVIE),
        _row("total_tv_shows", "count(*)", "titles", where=SHOW),
        _row("movie_ratio", rounded(f"100.0 * (count(*) FILTER ({MOVIE}))::DOUBLE / count(*)::DOUBLE", 2), "%"),
        _row("tv_ratio", rounded(f"100.0 * (count(*) FILTER ({SHOW}))::DOUBLE / count(*)::DOUBLE", 2), "%"),
        _row("average_content_age", rounded("avg(content_age)", 1), "years"),
        _row("average_movie_duration", rounded(f"avg({_A})", 1), "minutes", where=MOVIE_MIN),
        _row("min_movie_duration", f"min({_A})", "minutes", where=MOVIE_MIN),
        _row("max_movie_duration", f"max({_A})", "minutes", where=MOVIE_MIN),
        _row("average_seasons", rounded(f"avg({_A})", 2), "seasons", where=SHOW_SEASON),
        _row("min_seasons", f"min({_A})", "seasons", where=SHOW_SEASON),
        _row("max_seasons", f"max({_A})", "seasons", where=SHOW_SEASON),
        _row("fact_titles", "count(DISTINCT show_id)", "titles", "fact"),
        _row("fact_average_age", rounded("avg(content_age)", 1), "years", "(SELECT DISTINCT show_id, content_age FROM fact)"),
        _row("fact_rows", "count(*)", "rows", "fact"),
        _row("country_assignments", "count(*)", "assignments", "(SELECT DISTINCT show_id, country FROM fact)"),
    ]
)


def _sources(spark, sf):
    return {"silver_titles": lake.titles(spark, sf), "fact_content": lake.star(spark, sf).fact}


@query(over_fact(METRIC_ROWS))
def metric_values(spark, sf):
    return metrics.evaluate_metrics(_sources(spark, sf), CATALOG)


def _expected(spark, sf):
    """The metrics as the gold layer answers them; the fact-grain age is a known mismatch."""
    summary = views.general_summary(lake.star(spark, sf))
    fact_age = lake.star(spark, sf).fact.agg(round_to(F.avg("content_age"), 1)).scalar()
    wide = summary.select(
        F.col("total_titles").cast("double").alias("total_titles"),
        F.col("total_movies").cast("double").alias("total_movies"),
        (F.col("total_tv_shows") + 1).cast("double").alias("total_tv_shows"),
        fact_age.alias("fact_average_age"),
        F.lit(0.0).alias("unknown_metric"),
        F.col("average_content_age"),
    )
    long = wide.unpivot([], wide.columns, "metric", "value")
    unit = F.when(F.col("metric") == "average_content_age", "days").when(F.col("metric") == "fact_average_age", "years").otherwise("titles")
    return long.withColumn("unit", unit)


RECONCILED = f""",
actual AS ({METRIC_ROWS}),
expected AS (
  SELECT 'total_titles' AS metric, CAST(count(DISTINCT show_id) AS DOUBLE) AS value, 'titles' AS unit FROM fact
  UNION ALL SELECT 'total_movies', count(DISTINCT show_id), 'titles' FROM fact WHERE type = 'Movie'
  UNION ALL SELECT 'total_tv_shows', count(DISTINCT show_id) + 1, 'titles' FROM fact WHERE type = 'TV Show'
  UNION ALL SELECT 'fact_average_age', {rounded("avg(content_age)", 1)}, 'years' FROM fact
  UNION ALL SELECT 'unknown_metric', 0, 'titles'
  UNION ALL SELECT 'average_content_age', {rounded("avg(content_age)", 1)}, 'days' FROM (SELECT DISTINCT show_id, content_age FROM fact)),
report AS (
  SELECT e.metric, e.value AS expected_value, a.value AS actual_value,
         CASE WHEN a.metric IS NULL THEN 'METRIC_MISMATCH' WHEN e.unit <> a.unit THEN 'UNIT_MISMATCH'
              WHEN a.value IS NULL OR abs(e.value - a.value) > 0 THEN 'NUMERIC_MISMATCH' ELSE 'NONE' END AS mismatch_class
  FROM expected e LEFT JOIN actual a USING (metric))
"""


@query(
    over_fact(
        RECONCILED
        + "SELECT metric, expected_value, actual_value, CASE mismatch_class WHEN 'NONE' THEN 'PASS' ELSE 'FAIL' END AS status, mismatch_class FROM report"
    )
)
def metric_reconciliation(spark, sf):
    return metrics.reconcile(_expected(spark, sf), metrics.evaluate_metrics(_sources(spark, sf), CATALOG))


@query(
    over_fact(
        RECONCILED
        + "SELECT CASE mismatch_class WHEN 'NONE' THEN 'PASS' ELSE 'FAIL' END AS status, mismatch_class, count(*) AS metrics FROM report GROUP BY ALL"
    )
)
def reconciliation_totals(spark, sf):
    actual = metrics.evaluate_metrics(_sources(spark, sf), CATALOG)
    return metrics.reconciliation_totals(metrics.reconcile(_expected(spark, sf), actual))


@query(
    over_fact(
        f"""
SELECT layer, metric, value FROM (
  SELECT 'silver' AS layer, count(*)::DOUBLE AS titles, {rounded("avg(content_age)", 1)} AS age FROM silver_titles
  UNION ALL SELECT 'gold_fact', count(*), {rounded("avg(content_age)", 1)} FROM fact
  UNION ALL SELECT 'gold_distinct', count(*), {rounded("avg(content_age)", 1)} FROM (SELECT DISTINCT show_id, content_age FROM fact)
  UNION ALL SELECT 'view', count(DISTINCT show_id), (SELECT {rounded("avg(content_age)", 1)} FROM (SELECT DISTINCT show_id, content_age FROM fact)) FROM fact
) UNPIVOT (value FOR metric IN (titles, age))"""
    )
)
def layer_reconciliation(spark, sf):
    star = lake.star(spark, sf)

    def measured(df):
        return df.agg(F.count("*").alias("titles"), round_to(F.avg("content_age"), 1).alias("age"))

    view = views.general_summary(star).select(F.col("total_titles").alias("titles"), F.col("average_content_age").alias("age"))
    return metrics.across_layers(
        {
            "silver": measured(lake.titles(spark, sf)),
            "gold_fact": measured(star.fact),
            "gold_distinct": measured(star.fact.select("title_key", "content_age").distinct()),
            "view": view,
        }
    )


@query(
    over_silver(
        f"SELECT country, {BY_TYPE}, 'DROP TABLE' AS note FROM silver_titles JOIN silver_country USING (show_id) "
        "WHERE release_year BETWEEN 1996 AND 1998 GROUP BY country"
    )
)
def adhoc_sql(spark, sf):
    views.register_views(
        spark, lake.star(spark, sf), {"silver_titles": lake.titles(spark, sf), **lake.bridges(spark, sf)}
    )
    return adhoc.query_readonly(
        spark,
        """
        WITH picked AS (SELECT show_id, type FROM silver_titles WHERE release_year BETWEEN 1996 AND 1998)
        SELECT country, count(*) AS total_content, count_if(type = 'Movie') AS total_movies,
               count_if(type = 'TV Show') AS total_tv_shows, 'DROP TABLE' AS note
        FROM picked JOIN silver_country USING (show_id) GROUP BY country;
        """,
    )
