import math
import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.operators import clusters, forest, stats


def test_trend_and_forecast_against_numpy(spark):
    rng = np.random.default_rng(1)
    years = list(range(1995, 2022))
    counts = [int(40 * (y - 1994) + rng.integers(-60, 60)) for y in years]
    trend = stats.ols_trend(spark.createDataFrame(list(zip(years, counts)), "y int, n int"), "y", "n")
    slope, intercept = np.polyfit(years, counts, 1)
    row = trend.first()
    assert row.slope == pytest.approx(slope) and row.intercept == pytest.approx(intercept)
    assert row.r2 == pytest.approx(np.corrcoef(years, counts)[0, 1] ** 2)
    assert (row.train_from, row.train_to, row.points) == (1995, 2021, 27)
    got = {r.period: r.predicted for r in stats.forecast(trend).collect()}
    assert got == {y: max(0, int(round(slope * y + intercept))) for y in range(2022, 2027)}


def test_trend_needs_five_points_and_forecast_is_never_negative(spark):
    few = spark.createDataFrame([(i, 2 * i) for i in range(4)], "x int, y int")
    assert stats.ols_trend(few, "x", "y").count() == 0
    falling = spark.createDataFrame([(i, 10 - 3 * i) for i in range(5)], "x int, y int")
    assert {r.predicted for r in stats.forecast(stats.ols_trend(falling, "x", "y")).collect()} == {0}


def test_zscore_outlier(spark):
    data = [(f"c{i}", 10) for i in range(9)] + [("big", 100)]
    rows = stats.zscore_outliers(spark.createDataFrame(data, "name string, n int"), "name", "n").collect()
    assert [tuple(r) for r in rows] == [("big", 100, 3.0, "Significantly higher title volume (100 vs avg 19)")]


def test_standardize_handles_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert sorted(tuple(r) for r in stats.standardize(df, ["a", "b"]).collect()) == [(-1.0, 0.0), (1.0, 0.0)]


def _points(spark):
    rng = np.random.default_rng(5)
    data = [(f"p{i}", float(x), float(y)) for i, (x, y) in enumerate(rng.normal(0, 1, (600, 2)))]
    return spark.createDataFrame(data + [("far1", 15.0, 15.0), ("far2", -14.0, 16.0)], "name string, x double, y double")


def test_isolation_forest_finds_planted_points_whatever_the_partitioning(spark):
    points = _points(spark)
    scored = forest.isolation_scores(points.repartition(7), "name", ["x", "y"])
    again = forest.isolation_scores(points.coalesce(1), "name", ["x", "y"])
    a, b = ({r.name: round(r.score, 9) for r in s.collect()} for s in (scored, again))
    assert a == b and len(a) == 602 and all(0 < s < 1 for s in a.values())
    assert set(sorted(a, key=a.get)[-2:]) == {"far1", "far2"}
    found = forest.isolation_outliers(points, "name", ["x", "y"])
    assert 0.10 <= found.count() / 602 <= 0.16


@pytest.mark.parametrize("rows", [500, 100_000])
def test_trees_draw_from_all_rows_by_one_rule(spark, rows):
    points = spark.range(rows).select(F.concat(F.lit("p"), "id").alias("name"), F.rand(3).alias("x"))
    sample = forest._sample(points, "name", rows, trees=10, psi=64, seed=42)
    drawn = {t: {r.name for r in sample.filter(F.col("tree") == t).collect()} for t in range(2)}
    smallest = F.xxhash64("name", F.col("tree"), F.lit(42))
    for tree, names in drawn.items():
        assert names == {r.name for r in points.withColumn("tree", F.lit(tree)).orderBy(smallest, "name").limit(64).collect()}
    assert {r["count"] for r in sample.groupBy("tree").count().collect()} == {64}


def test_quantile_is_exact(spark):
    values = [((i * 7919) % 30_011) / 7 for i in range(30_011)]
    df = spark.createDataFrame([(v,) for v in values], "s double").repartition(7)
    ranked = sorted(values)
    for share in (0.0, 0.5, 0.85, 1.0):
        assert df.select(forest._quantile(df, "s", share)).first()[0] == ranked[max(math.ceil(share * len(values)), 1) - 1]


def test_average_path_lengths():
    assert forest.average_path(1) == 0 and forest.average_path(2) == 1
    assert forest.average_path(256) == pytest.approx(10.244, abs=1e-3)


def test_kmeans_recovers_separate_groups(spark):
    rng = np.random.default_rng(2)
    data = [(f"{g}{i}", float(m + rng.normal()), float(m + rng.normal())) for g, m in (("a", 0), ("b", 50), ("c", 100)) for i in range(20)]
    df = spark.createDataFrame(data, "name string, x double, y double").repartition(5)
    members = clusters.kmeans_members(df, "name", ["x", "y"], starts=3)
    assert {(r.cluster, r.member[0]) for r in members.collect()} == {(1, "a"), (2, "b"), (3, "c")}
    assert {r.members for r in clusters.cluster_sizes(members).collect()} == {20}
    with pytest.raises(ValueError, match="at least 4"):
        clusters.kmeans_members(df.limit(3), "name", ["x", "y"])
