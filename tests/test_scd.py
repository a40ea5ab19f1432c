from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace.operators import scd
from terrace.plans.incremental import apply_scd2

from fixtures import titles_frame

COMPARE = ["type", "title", "date_added", "release_year", "rating", "duration", "description"]
KEYS = ["show_id"]
NOW, AS_OF = datetime(2026, 7, 20, 9), date(2026, 7, 20)


def title(show_id, name, rating, year, batch, **more):
    return {"show_id": show_id, "type": "Movie", "title": name, "rating": rating, "release_year": year, "batch_id": batch, **more}


@pytest.fixture
def type1(spark):
    target = titles_frame(spark, [title("s1", "Initial Title", "PG", 2020, "b1"), title("s2", "Unchanged Title", "TV-MA", 2021, "b1")])
    source = titles_frame(
        spark,
        [title("s1", "Updated Title", "PG-13", 2020, "b2"), title("s2", "Unchanged Title", "TV-MA", 2021, "b2"), title("s3", "New Title", "R", 2022, "b2")],
    )
    return target, source


def test_type1_merge(type1):
    got = {r.show_id: (r.title, r.rating, r.batch_id) for r in scd.scd1_merge(*type1, KEYS, COMPARE).collect()}
    assert got == {
        "s1": ("Updated Title", "PG-13", "b2"),
        "s2": ("Unchanged Title", "TV-MA", "b1"),  # equal compared columns keep the old audit columns
        "s3": ("New Title", "R", "b2"),
    }
    stats = {r.action: r.row_count for r in scd.merge_stats(scd.scd1_actions(*type1, KEYS, COMPARE)).collect()}
    assert stats == {"inserted": 1, "updated": 1, "unchanged": 1}


def test_type1_first_load_and_target_only_rows(type1):
    target, source = type1
    assert scd.scd1_merge(None, source, KEYS, COMPARE).count() == 3
    kept = scd.scd1_merge(target, source.filter("show_id = 's3'"), KEYS, COMPARE)
    assert sorted(r.show_id for r in kept.collect()) == ["s1", "s2", "s3"]


@pytest.fixture
def type2(spark):
    base = titles_frame(spark, [title("s1", "Initial Title", "PG", 2020, "b1"), title("s2", "Unchanged Title", "TV-MA", 2021, "b1")])
    target = scd.scd2_initial(base, KEYS, date(2026, 7, 1), datetime(2026, 7, 1))
    source = titles_frame(
        spark,
        [
            title("s1", "Updated Title", "PG", 2020, "b2"), title("s2", "Unchanged Title", "TV-MA", 2021, "b2"),
            title("s3", "New Title", "R", 2022, "b2"), title("s3", "Duplicate New Title", "R", 2022, "b2"),
        ],
    )
    return target, source


def FIRST():
    return [F.length("title").asc()]


def test_type2_merge(type2):
    merged = scd.scd2_merge(*type2, KEYS, COMPARE, AS_OF, NOW, FIRST())
    got = {(r.show_id, r.version_number): r for r in merged.collect()}
    assert set(got) == {("s1", 1), ("s1", 2), ("s2", 1), ("s3", 1)}
    old, new = got["s1", 1], got["s1", 2]
    assert (old.is_current, old.effective_end_date) == (False, AS_OF - timedelta(days=1))
    assert (new.is_current, new.effective_start_date, new.effective_end_date) == (True, AS_OF, date(9999, 12, 31))
    assert (new.record_created_timestamp, new.record_updated_timestamp) == (datetime(2026, 7, 1), NOW)
    assert got["s2", 1].effective_start_date == date(2026, 7, 1)
    assert got["s3", 1].title == "New Title"
    stats = {r.action: r.row_count for r in scd.merge_stats(scd.scd2_actions(*type2, KEYS, COMPARE, AS_OF, NOW, FIRST())).collect()}
    assert stats == {"inserted": 1, "new_version": 1, "expired": 1, "unchanged": 1}


def test_type2_merge_again_changes_nothing(type2):
    target, source = type2
    once = scd.scd2_merge(target, source, KEYS, COMPARE, AS_OF, NOW, FIRST())
    twice = scd.scd2_merge(once, source, KEYS, COMPARE, AS_OF, NOW, FIRST())
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    assert scd.scd2_changes(once, source, KEYS, COMPARE, AS_OF, NOW, FIRST()).isEmpty()


def test_same_day_second_change_is_left_out_of_the_as_of_view(type2):
    target, source = type2
    once = scd.scd2_merge(target, source, KEYS, COMPARE, AS_OF, NOW, FIRST())
    again = scd.scd2_merge(once, source.withColumn("title", F.concat("title", F.lit("!"))), KEYS, COMPARE, AS_OF, NOW, FIRST())
    seen = {r.show_id: r.version_number for r in scd.as_of_view(again, AS_OF).collect()}
    assert seen == {"s1": 3, "s2": 2, "s3": 2}
    assert again.filter("effective_end_date < effective_start_date").count() == 2


def test_target_without_version_columns_is_a_first_load(type1):
    target, source = type1
    assert {r.version_number for r in scd.scd2_merge(target, source, KEYS, COMPARE, AS_OF, NOW).collect()} == {1}


def test_stored_merge_moves_rows_between_partitions(spark, type2, tmp_path):
    target, source = type2
    path = str(tmp_path / "history")
    target.write.partitionBy("release_year").parquet(path)
    moved = source.withColumn("release_year", F.when(F.col("show_id") == "s1", 1999).otherwise(F.col("release_year")))
    untouched = {p: sorted(f.name for f in (tmp_path / "history" / p).iterdir()) for p in ("release_year=2021",)}
    stats = apply_scd2(spark, path, moved, KEYS, COMPARE, AS_OF, NOW, "release_year", FIRST())
    assert stats == {"inserted": 1, "expired": 1, "new_version": 1}
    stored = spark.read.parquet(path)
    expected = scd.scd2_merge(target, moved, KEYS, COMPARE, AS_OF, NOW, FIRST())
    assert sorted(map(str, stored.select(*sorted(stored.columns)).collect())) == sorted(map(str, expected.select(*sorted(stored.columns)).collect()))
    assert untouched == {p: sorted(f.name for f in (tmp_path / "history" / p).iterdir()) for p in untouched}
    assert apply_scd2(spark, path, moved, KEYS, COMPARE, AS_OF, NOW, "release_year", FIRST()) == {"inserted": 0, "expired": 0, "new_version": 0}
    assert stored.count() == 4


def test_stored_merge_with_a_missing_partition_value(spark, tmp_path):
    path = str(tmp_path / "history")
    first = titles_frame(spark, [title("s1", "A", "PG", None, "b1"), title("s2", "B", "PG", 2000, "b1")])
    apply_scd2(spark, path, first, KEYS, COMPARE, date(2026, 1, 1), NOW, "release_year")
    changed = titles_frame(spark, [title("s1", "A2", "PG", None, "b2")])
    apply_scd2(spark, path, changed, KEYS, COMPARE, AS_OF, NOW, "release_year")
    got = sorted((r.show_id, r.title, r.version_number, r.is_current) for r in spark.read.parquet(path).collect())
    assert got == [("s1", "A", 1, False), ("s1", "A2", 2, True), ("s2", "B", 1, True)]


feed = st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["x", "y", None])), max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(feed, min_size=1, max_size=3))
def test_type2_against_a_plain_model(spark, feeds):
    """Feeds of (key, value) rows against a dictionary of versions."""
    schema = "k int, v string"
    model: dict[int, list[list]] = {}
    history = None
    for day, rows in enumerate(feeds):
        as_of = date(2026, 1, 1) + timedelta(days=10 * day)
        for k in {k for k, _ in rows}:
            # The kept row is the first value in order, missing ones last.
            v = sorted((r[1] for r in rows if r[0] == k), key=lambda x: (x is None, x))[0]
            versions = model.setdefault(k, [])
            if versions and versions[-1][0] == v:
                continue
            if versions:
                versions[-1][2] = as_of - timedelta(days=1)
            versions.append([v, as_of, date(9999, 12, 31)])
        history = scd.scd2_merge(history, spark.createDataFrame(rows, schema), ["k"], ["v"], as_of, NOW)
    got = sorted((r.k, r.version_number, str(r.v), r.effective_start_date, r.effective_end_date, r.is_current) for r in history.collect())
    want = sorted(
        (k, i + 1, str(v), start, end, i == len(versions) - 1)
        for k, versions in model.items()
        for i, (v, start, end) in enumerate(versions)
    )
    assert got == want


@pytest.mark.parametrize("small", [True, False])
def test_a_null_key_is_a_key(spark, small):
    """Replaying a batch with a NULL key changes nothing, in either join."""
    batch = spark.createDataFrame([(None, "x"), (1, "y")], "k int, v string")
    target = spark.createDataFrame([(2, "z")], "k int, v string")
    for _ in range(3):
        target = scd.scd1_actions(target, batch, ["k"], ["v"], small=small).drop("_action")
    assert sorted(map(tuple, target.collect()), key=str) == [(1, "y"), (2, "z"), (None, "x")]
    history = scd.scd2_initial(target, ["k"], AS_OF, NOW)
    for value, day in (("x", 21), ("w", 22), ("w", 23)):
        changed = batch.withColumn("v", F.when(F.col("k").isNull(), value).otherwise(F.col("v")))
        history = scd.scd2_actions(history, changed, ["k"], ["v"], date(2026, 7, day), NOW, small=small).drop("_action")
    got = sorted((str(r.k), r.v, r.version_number, r.is_current) for r in history.collect())
    assert got == [("1", "y", 1, True), ("2", "z", 1, True), ("None", "w", 2, True), ("None", "x", 1, False)]


@pytest.mark.parametrize("small", [True, False])
def test_both_joins_give_the_same_history(type2, small):
    target, source = type2
    merged = scd.scd2_actions(target, source, KEYS, COMPARE, AS_OF, NOW, FIRST(), small)
    assert sorted((r.show_id, r.title, r.version_number, r._action) for r in merged.collect()) == [
        ("s1", "Initial Title", 1, "expired"), ("s1", "Updated Title", 2, "new_version"),
        ("s2", "Unchanged Title", 1, "unchanged"), ("s3", "New Title", 1, "inserted"),
    ]


def test_a_merge_reads_target_and_incoming_once(spark, tmp_path):
    for name in ("target", "source"):
        spark.range(1000).select(F.col("id").alias("k"), F.lit(name).alias("v")).write.parquet(str(tmp_path / name))
    target, source = (spark.read.parquet(str(tmp_path / n)) for n in ("target", "source"))
    for merged in (
        scd.scd1_actions(target, source, ["k"], ["v"], scd.UNIQUE, small=False),
        scd.scd2_actions(scd.scd2_initial(target, ["k"], AS_OF, NOW, scd.UNIQUE), source, ["k"], ["v"], AS_OF, NOW, scd.UNIQUE, small=False),
    ):
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 2 and "FullOuter" in plan
