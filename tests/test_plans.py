"""Shapes of physical plans that matter at scale."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from suite import all_queries, lake
from terrace.functions import predicates
from terrace.operators import quality, scd, tables
from terrace.plans import business, silver, star as star_layer, views

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_watermark_filter_reaches_the_scan(spark):
    df = predicates.newer_than(lake.table(spark, SF, "events"), "ts", datetime(2024, 1, 15)).select("event_id")
    assert "GreaterThan(ts," in plan(df) and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan(df)


def test_deduplication_limits_each_key_before_the_shuffle(spark):
    p = plan(tables.latest_by_key(lake.table(spark, SF, "lineitem"), ["l_orderkey"], [F.desc("l_shipdate")]))
    assert p.index("Final") < p.index("Exchange") < p.index("Partial")


def test_distinct_counts_do_not_copy_rows(spark):
    p = plan(views.general_summary(lake.star(spark, SF)))
    assert "Expand" not in p


def test_merge_does_not_shuffle_the_target_for_a_small_batch(spark):
    target = scd.scd2_initial(lake.table(spark, SF, "customer"), ["c_custkey"], date(2024, 1, 1), datetime(2024, 1, 1))
    path = f"{lake._home(spark, SF)}/plan-target"
    target.write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    source = spark.read.parquet(path).select(*lake.table(spark, SF, "customer").columns).limit(5)
    p = plan(scd.scd2_actions(stored, source, ["c_custkey"], ["c_acctbal"], date(2024, 2, 1), datetime(2024, 2, 1)))
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" in p


def _stored_many(spark, tmp_path):
    """More rows than a broadcast may hold in files far below Spark's broadcast limit."""
    path = str(tmp_path / "many")
    spark.range(0, tables.FEW + 50_000, 1, 4).select(F.concat(F.lit("s"), "id").alias("show_id"), F.lit("Kenya").alias("country")).write.parquet(path)
    return spark.read.parquet(path)


def test_many_rows_in_small_files_are_not_broadcast(spark, tmp_path):
    many = _stored_many(spark, tmp_path)
    titles = many.select("show_id", F.lit("Movie").alias("type"))
    joins = [
        tables.matching(titles, many, ["show_id"]),
        tables.matching(titles, many, ["show_id"], "left_anti"),
        tables.replace_bridge(many, many, "show_id"),
        business.distribution(titles, many, "country"),
        business.top_genres_by_country(titles, many, many.withColumnRenamed("country", "genre")),
        views.with_attributes(star_layer.Star(many.withColumnRenamed("show_id", "title_key"), {"dim_title": many.toDF("title_key", "title")}), "title"),
    ]
    for df in joins:
        p = plan(df)
        assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p


def test_few_rows_are_broadcast_and_joins_are_unchanged(spark, tmp_path):
    many = _stored_many(spark, tmp_path)
    few = many.limit(7)
    assert tables.is_small(few) and not tables.is_small(many)
    kept = tables.matching(many, few, ["show_id"])
    assert "BroadcastHashJoin" in plan(kept) and kept.count() == 7
    assert tables.matching(many, many, ["show_id"]).count() == many.count()


def test_star_build_does_not_broadcast_bridges_of_many_rows(spark, tmp_path):
    many = _stored_many(spark, tmp_path)
    columns = {"rating": "string", "type": "string", "date_added": "date", "duration_minutes": "int", "season_count": "int", "release_year": "int", "content_age": "int", "ingestion_timestamp": "timestamp"}
    titles = many.select("show_id", *(F.lit(None).cast(t).alias(c) for c, t in columns.items()))
    fact = star_layer.build_fact(titles, many, many.toDF("show_id", "genre"), many.toDF("show_id", "director"), "b", "r")
    assert "BroadcastHashJoin" not in plan(fact)


@pytest.mark.parametrize("name", ["country_distribution_view", "genre_shares", "executive_row", "metric_values", "rejected_records", "fact_content"])
def test_no_cartesian_joins(spark, name):
    p = plan(all_queries()[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_uniqueness_is_judged_without_a_window(spark):
    p = plan(quality.with_reasons(lake.bronze(spark, SF), {"unique_checks": ["show_id"]}))
    assert "Window" not in p


def test_director_ranking_has_no_global_window(spark):
    ranked = business.director_rankings(lake.titles(spark, SF), lake.bridges(spark, SF)["silver_directors"])
    # The only single-task window is over one row per shuffle slice.
    assert plan(ranked).count("Window ") <= 1


def test_watermark_prunes_bronze_partitions(spark, tmp_path):
    path = str(tmp_path / "bronze")
    events = lake.table(spark, SF, "events").withColumns({"ts": F.col("ts").cast("timestamp"), "ingestion_date": F.to_date("ts")})
    events.write.partitionBy("ingestion_date").parquet(path)
    stored = spark.read.parquet(path)
    newer = predicates.newer_than(stored, "ts", datetime(2024, 1, 15, 12), "ingestion_date")
    assert newer.count() == stored.filter("ts > TIMESTAMP '2024-01-15 12:00:00'").count() > 0
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan(newer) and "GreaterThan(ts," in plan(newer)


def test_each_text_is_squashed_once(spark):
    rows = spark.createDataFrame([("a",) * len(silver.RAW_COLUMNS)], silver.RAW_COLUMNS)
    optimized = silver.clean(rows.repartition(2))._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("regexp_replace") == len(silver.TEXT_COLUMNS)


def test_lines_are_shuffled_as_rows_and_not_as_lists(spark):
    lists = plan(lake.raw_catalog(spark, SF)).rsplit("partial_collect_set", 1)[1]
    assert lists.lstrip().split("Exchange", 1)[1].startswith(" hashpartitioning(l_orderkey")


def test_a_replaced_bridge_is_dealt_by_its_rows(spark, tmp_path, monkeypatch):
    many = _stored_many(spark, tmp_path)
    monkeypatch.setattr(tables, "TASK_ROWS", 20_000)
    replaced = tables.replace_bridge(many, many.filter("show_id < 's9'").withColumn("country", F.lit("Peru")), "show_id")
    dealt = [line for line in plan(replaced).splitlines() if "Exchange" in line]
    assert len(dealt) == 2 and all(f", {math.ceil(many.count() / 20_000)}), " in line for line in dealt)
    assert dict(replaced.groupBy("country").count().collect()) == {"Kenya": many.filter("show_id >= 's9'").count(), "Peru": many.filter("show_id < 's9'").count()}
    assert "BroadcastHashJoin" in plan(tables.filtered_by(many, many.limit(3), "show_id", "left_anti"))


def test_null_keys_of_a_bridge_stay(spark, monkeypatch):
    old = spark.createDataFrame([(None, "a"), ("s1", "a"), ("s1", "a"), ("s2", "b")], "show_id string, country string")
    new = spark.createDataFrame([(None, "x"), ("s1", "y"), ("s1", "z")], "show_id string, country string")
    for limit in (0, 100):
        monkeypatch.setattr(tables.is_small, "__defaults__", (limit,))
        assert sorted(map(str, (tuple(r) for r in tables.replace_bridge(old, new, "show_id").collect()))) == sorted(
            map(str, [(None, "a"), ("s2", "b"), (None, "x"), ("s1", "y"), ("s1", "z")])
        )
