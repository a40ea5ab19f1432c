import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace.operators import ranking, rollups, tables
from terrace.plans import adhoc, telemetry
from terrace.sources import sinks

hypo = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@hypo
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=60))
def test_latest_by_key_against_a_plain_model(spark, data):
    df = spark.createDataFrame(data, "k int, v int").repartition(4)
    got = sorted((r.k, r.v) for r in tables.latest_by_key(df, ["k"], [F.desc("v")]).collect())
    assert got == sorted({k: max(v for kk, v in data if kk == k) for k, _ in data}.items())


def test_global_rank_with_one_hot_value(spark):
    rng = random.Random(7)
    data = [(1 if rng.random() < 0.6 else rng.randint(2, 9), f"n{i:04d}") for i in range(2000)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "n int, name string").repartition(5)
    ranked = ranking.global_rank(df, [F.desc("n"), F.asc("name")], "rk")
    want = {name: i + 1 for i, (_, name) in enumerate(sorted(data, key=lambda r: (-r[0], r[1])))}
    assert {r.name: r.rk for r in ranked.collect()} == want


def test_dense_rank_keeps_ties(spark):
    df = spark.createDataFrame([("a", i, n) for i, n in enumerate([9, 9, 8, 7, 7, 6])], "g string, id int, n int")
    top = ranking.top_n_per_group(df, ["g"], [F.desc("n")], 3, "rk")
    assert sorted(r.id for r in top.collect()) == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("policy,expected", [("update", {1: "a", 2: "B", 3: "C"}), ("nothing", {1: "a", 2: "b", 3: "C"})])
def test_upsert(spark, policy, expected):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([("B", 2, 0), ("C", 3, 0)], "v string, k int, extra int")
    assert {r.k: r.v for r in tables.upsert(target, source, ["k"], policy).collect()} == expected


def test_replace_touches_only_named_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(100).withColumn("p", F.col("id") % 4), path, partition_by=["p"])
    kept = sorted(f.name for f in (tmp_path / "t" / "p=1").iterdir())
    sinks.replace_partitions(spark.read.parquet(path).filter("p = 2").withColumn("id", F.col("id") + 1000), path, ["p"])
    after = spark.read.parquet(path)
    assert after.count() == 100 and after.filter("p = 2 AND id < 1000").isEmpty()
    assert sorted(f.name for f in (tmp_path / "t" / "p=1").iterdir()) == kept
    sinks.replace_table(spark.read.parquet(path).filter("p = 1"), path, ["p"])
    assert spark.read.parquet(path).count() == 25


def test_delete_cascades_to_children(spark):
    parent = spark.createDataFrame([("s1", 11), ("s2", 12)], "show_id string, title_key int")
    child = spark.createDataFrame([(11, 1), (11, 2), (12, 3)], "title_key int, n int")
    parents, children = tables.delete_cascade(parent, child, spark.createDataFrame([("s1",)], "show_id string"), "show_id", "title_key")
    assert [r.show_id for r in parents.collect()] == ["s2"] and [r.n for r in children.collect()] == [3]


def test_explode_list_drops_blanks(spark):
    df = spark.createDataFrame([("s1", " india,, south  africa ,"), ("s2", None)], "show_id string, c string")
    got = sorted(tuple(r) for r in tables.explode_list(df, "show_id", "c", "v", True).collect())
    assert got == [("s1", "India"), ("s1", "South  Africa")]


def test_rollup_matches_distinct_counts(spark):
    rng = random.Random(3)
    data = [(rng.choice("ab"), rng.randint(0, 30), rng.choice(["M", "T"]), rng.randint(0, 9)) for _ in range(500)]
    df = spark.createDataFrame(data, "g string, e int, t string, v int")
    got = rollups.entity_rollup(df, ["g"], "e", {"m": F.col("t") == "M"}, {"avg_v": ("v", 3)}, out="n")
    want = df.groupBy("g").agg(
        F.count_distinct("e").alias("n"),
        F.count_distinct(F.when(F.col("t") == "M", F.col("e"))).alias("m"),
        F.round(F.avg("v"), 3).alias("avg_v"),
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    sketch = {r.g: r.n for r in rollups.entity_rollup(df, ["g"], "e", out="n", approx=True).collect()}
    assert all(abs(sketch[r.g] - r.n) <= 3 for r in want.collect())


def test_align_and_blank(spark):
    target = spark.createDataFrame([], "a int, b string, c double")
    got = tables.blank_to_null(tables.align_to(spark.createDataFrame([("", 1, 5)], "b string, a long, z int"), target.schema))
    assert got.dtypes == target.dtypes and tuple(got.first()) == (1, None, None)


@pytest.mark.parametrize(
    "sql",
    [
        "DROP TABLE t", "INSERT INTO t SELECT 1", "CREATE VIEW v AS SELECT 1", "SET x = 1", "SELECT 1; DROP TABLE t",
        "SELECT 1) a; DROP TABLE t --", "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", "TRUNCATE TABLE t", "",
        "SHOW TABLES", "DESCRIBE TABLE t", "SELECT TRANSFORM(id) USING 'cat' AS (a) FROM range(3)", "SELECT java_method('java.lang.Math', 'random')",
        "SELECT id FROM range(3) WHERE EXISTS (SELECT reflect('java.lang.Math', 'random'))", "SELECT * FROM parquet.`/tmp/x`",
        "SELECT (SELECT max(a) FROM json.`/tmp/x`) AS m", "WITH a AS (SELECT try_reflect('java.lang.Math', 'random') AS r) SELECT r FROM a",
    ],
)
def test_statements_that_are_no_query_are_refused(spark, sql):
    with pytest.raises(adhoc.NotAQuery):
        adhoc.query_readonly(spark, sql)


def test_queries_run_and_keep_their_order(spark):
    df = adhoc.query_readonly(spark, "SELECT id, 'DROP TABLE x; DELETE' AS s FROM range(5) ORDER BY id DESC;")
    assert [r.id for r in df.collect()] == [4, 3, 2, 1, 0]
    assert adhoc.query_readonly(spark, "WITH a AS (SELECT 1 AS x) SELECT x FROM a -- trailing remark").first().x == 1


def test_telemetry_rows(spark, tmp_path):
    path = str(tmp_path / "runs")
    for i, status in enumerate(["SUCCESS", "FAILED", "SUCCESS"]):
        telemetry.record(spark, path, telemetry.RUN_SCHEMA, {"pipeline_run_id": f"r{i}", "execution_status": status, "start_time": __import__("datetime").datetime(2026, 1, 1 + i)})
    runs = spark.read.parquet(path)
    assert telemetry.latest_success(runs).first().pipeline_run_id == "r2"
    assert [r.pipeline_run_id for r in telemetry.failed_runs(runs).collect()] == ["r1"]
    assert [r.pipeline_run_id for r in telemetry.duration_trend(runs).collect()] == ["r0", "r1", "r2"]


def _partitions(spark, path):
    return sorted((r.p, r.id) for r in spark.read.parquet(path).collect())


def test_a_replacement_that_dies_is_finished_or_dropped(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.replace_table(spark.range(8).withColumn("p", F.col("id") % 4), path, ["p"])
    before = _partitions(spark, path)
    changed = spark.read.parquet(path).filter("p < 3").withColumn("id", F.col("id") + 100)
    after = sorted((p, i + 100 if p < 3 else i) for p, i in before)
    move, moved = sinks._move, []

    def dying(spark, source, target):
        if len(moved) == 1:
            raise RuntimeError("the driver dies between two partitions")
        moved.append(target)
        move(spark, source, target)

    monkeypatch.setattr(sinks, "_move", dying)
    with pytest.raises(RuntimeError):
        sinks.replace_partitions(changed, path, ["p"])
    monkeypatch.setattr(sinks, "_move", move)
    assert _partitions(spark, path) not in (before, after)
    sinks.recover(spark, path)
    assert _partitions(spark, path) == after
    assert not list((tmp_path / "t__pending").iterdir())

    (tmp_path / "t__pending" / "never" / "partitions" / "p=0").mkdir(parents=True)  # written in part, not committed
    sinks.recover(spark, path)
    assert _partitions(spark, path) == after


def test_a_table_lost_while_it_was_swapped_comes_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.replace_table(spark.range(3), path)
    monkeypatch.setattr(sinks, "_swap", lambda *a: sinks.discard(spark, path))  # the old files are gone, the new not there
    sinks.replace_table(spark.read.parquet(path).filter("id > 0"), path)
    monkeypatch.undo()
    assert not sinks.table_exists(spark, path)
    sinks.recover(spark, path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2]
    (tmp_path / "half" / "_temporary").mkdir(parents=True)
    assert not sinks.table_exists(spark, str(tmp_path / "half"))
