"""Regression, forecast, outliers and clusters over grouped results (M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite import lake
from suite.kpis import COUNTRY_PROFILE
from suite.lake import over_fact, rounded, table
from suite.registry import query
from terrace.operators import clusters, forest, rollups, stats
from terrace.operators.tables import by_rows
from terrace.plans import views

FEATURES = ["titles_count", "movie_count", "tv_count", "avg_movie_duration", "avg_content_age"]
YEARLY = "SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n FROM orders GROUP BY 1"
YEARLY_BY = "SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n FROM orders GROUP BY 1, 2"
LINE = (
    f"{rounded('regr_slope(n, y)', 2)} AS slope, {rounded('regr_intercept(n, y)', 2)} AS intercept, {rounded('regr_r2(n, y)', 4)} AS r2, "
    "min(y) AS train_from, max(y) AS train_to, count(*) AS points"
)


def _yearly(spark, sf, *by):
    return table(spark, sf, "orders").groupBy(*by, F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))


@query(f"SELECT {LINE} FROM ({YEARLY})")
def order_trend(spark, sf):
    return stats.rounded_trend(stats.ols_trend(_yearly(spark, sf), "y", "n"))


@query(f"SELECT o_orderpriority, {LINE} FROM ({YEARLY_BY}) GROUP BY o_orderpriority HAVING count(*) >= 5")
def order_trend_by_priority(spark, sf):
    return stats.rounded_trend(stats.ols_trend(_yearly(spark, sf, "o_orderpriority"), "y", "n", ["o_orderpriority"]))


@query(
    f"""
SELECT o_orderpriority, CAST(period AS INTEGER) AS period, greatest(0, CAST(round_even(CAST(CAST(b + a * period AS DECIMAL(38,6)) AS DOUBLE), 0) AS BIGINT)) AS predicted FROM (
  SELECT o_orderpriority, a, b, unnest(range(last + 1, last + 6)) AS period FROM (
    SELECT o_orderpriority, regr_slope(n, y) AS a, regr_intercept(n, y) AS b, max(y) AS last FROM ({YEARLY_BY}) GROUP BY 1 HAVING count(*) >= 5))"""
)
def order_forecast(spark, sf):
    trend = stats.ols_trend(_yearly(spark, sf, "o_orderpriority"), "y", "n", ["o_orderpriority"])
    return stats.forecast(trend, 5, ["o_orderpriority"])


@query(
    f"""
WITH c AS (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey),
s AS (SELECT avg(orders) AS m, stddev_pop(orders) + 1e-6 AS d FROM c)
SELECT o_custkey, orders, {rounded('abs((orders - m) / d)', 2)} AS z_score,
       'Significantly higher title volume (' || orders || ' vs avg ' || CAST(round_even(m, 0) AS BIGINT) || ')' AS reason
FROM c, s WHERE abs((orders - m) / d) > 1.8"""
)
def order_volume_outliers(spark, sf):
    volume = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    return stats.zscore_outliers(volume, "o_custkey", "orders")


@query(
    over_fact(
        f""", p AS ({COUNTRY_PROFILE}),
s AS (SELECT avg(titles_count) AS m1, stddev_pop(titles_count) AS s1, avg(avg_movie_duration) AS m2, stddev_pop(avg_movie_duration) AS s2 FROM p)
SELECT country_name, {rounded("(titles_count - m1) / s1", 6)} AS titles_count, {rounded("(avg_movie_duration - m2) / s2", 6)} AS avg_movie_duration FROM p, s"""
    )
)
def standardized_profile(spark, sf):
    from terrace.functions.ratios import round_to

    scaled = stats.standardize(views.country_profile(lake.star(spark, sf)), ["titles_count", "avg_movie_duration"])
    return scaled.select(
        "country_name", *(round_to(F.col(c), 6).alias(c) for c in ("titles_count", "avg_movie_duration"))
    )


def customer_profile(spark, sf):
    """One feature row per director (customer): volume by type, typical length and age, at title grain."""
    titles, bridge = lake.titles(spark, sf), lake.bridges(spark, sf)["silver_directors"]
    joined = titles.join(by_rows(bridge), "show_id").filter("director <> 'Unknown Director'")
    flags = {"movie_count": F.col("type") == "Movie", "tv_count": F.col("type") == "TV Show"}
    averages = {"avg_movie_duration": ("duration_minutes", 1), "avg_content_age": ("content_age", 1)}
    return rollups.entity_rollup(joined, ["director"], "show_id", flags, averages)


@query()
def isolation_outliers(spark, sf):
    return forest.detect_outliers(customer_profile(spark, sf), "director", FEATURES)


SPARSE = """
SELECT CAST(least(c_custkey % 40, 10) AS BIGINT) AS band, count(*) AS titles_count,
       avg(CASE WHEN c_custkey % 40 < 3 THEN c_acctbal END) AS avg_movie_duration FROM customer GROUP BY 1"""


@query(
    f"""
WITH p AS ({SPARSE}), s AS (SELECT avg(titles_count) AS m, stddev_pop(titles_count) + 1e-6 AS d FROM p)
SELECT band AS name, titles_count, CAST(NULL AS DOUBLE) AS movie_ratio_pct, CAST(NULL AS DOUBLE) AS avg_duration,
       {rounded('abs((titles_count - m) / d)', 2)} AS z_score,
       'Significantly higher title volume (' || titles_count || ' vs avg ' || CAST(round_even(m, 0) AS BIGINT) || ')' AS reason
FROM p, s WHERE abs((titles_count - m) / d) > 1.8"""
)
def outliers_of_sparse_profiles(spark, sf):
    """Only three bands have all features, so the volumes decide."""
    band = F.least(F.col("c_custkey") % 40, F.lit(10))
    profile = table(spark, sf, "customer").groupBy(band.cast("long").alias("band")).agg(
        F.count("*").alias("titles_count"), F.avg(F.when(F.col("c_custkey") % 40 < 3, F.col("c_acctbal"))).alias("avg_movie_duration")
    )
    return forest.detect_outliers(profile, "band", ["titles_count", "avg_movie_duration"])


def _far_customers(spark, sf):
    """Two measures per customer: small for most, far out for every fiftieth."""
    key, far = F.col("c_custkey"), F.col("c_custkey") % 50 == 0
    step = (key / 50).cast("long") % 10
    return table(spark, sf, "customer").select(
        "c_custkey", F.when(far, 500 + step * 50).otherwise(key % 7).alias("x"), F.when(far, -700 - step * 40).otherwise(key % 11).alias("y")
    )


@query("SELECT c_custkey FROM customer WHERE c_custkey % 50 = 0")
def planted_outliers(spark, sf):
    return forest.isolation_outliers(_far_customers(spark, sf), "c_custkey", ["x", "y"], contamination=0.02).select("c_custkey")


@query("SELECT CAST(c_custkey % 3 + 1 AS INTEGER) AS cluster, c_custkey AS member FROM customer")
def planted_clusters(spark, sf):
    key = F.col("c_custkey")
    points = table(spark, sf, "customer").select("c_custkey", (key % 3 * 100 + key % 5).alias("x"), (key % 3 * 80 + key % 7).alias("y"))
    return clusters.kmeans_members(points, "c_custkey", ["x", "y"])


@query()
def director_clusters(spark, sf):
    return clusters.kmeans_members(customer_profile(spark, sf), "director", FEATURES[:3])
