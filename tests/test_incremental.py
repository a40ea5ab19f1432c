import glob
import math
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from suite import history, lake
from terrace.plans import gold, incremental, silver, star
from terrace.sources import sinks, snapshots
from terrace.streaming import continuous

from fixtures import RAW, raw_frame

DAY = date(2026, 7, 14)


def _record(show_id, title, country="India"):
    return (show_id, "Movie", title, "D", "C", country, "July 1, 2021", "2021", "PG", "90 min", "Dramas", "text")


def _run(spark, layout, n, **more):
    return incremental.run_pipeline(
        spark, layout, batch_id=f"b{n}", run_id=f"r{n}", as_of=date(2026, 7, 13 + n), now=datetime(2026, 7, 13 + n, 12), **more
    )


@pytest.fixture
def layout(spark, tmp_path):
    first = str(tmp_path / "bronze_first")
    data = [_record("s1", "Title One", "United States"), _record("s2", "Title Two")]
    raw_frame(spark, data, datetime(2026, 7, 14)).write.parquet(first)
    return incremental.Layout([first], str(tmp_path / "lake"))


def test_full_then_delta_then_nothing(spark, layout, tmp_path):
    one = _run(spark, layout, 1, full=True)
    assert (one.status, one.processed, one.inserted, one.updated) == ("SUCCESS", 2, 2, 0)
    assert (one.duplicates, one.failed_dates, one.nulls_handled) == (0, 0, 0)

    second = str(tmp_path / "bronze_second")
    data = [_record("s3", "Title Three"), _record("s1", "Title One Updated", "United States, Canada")]
    legacy = raw_frame(spark, data, datetime(2026, 7, 14, 6)).withColumnsRenamed({"batch_id": "_batch_id", "ingestion_timestamp": "_ingested_at"})
    legacy.drop("pipeline_run_id").withColumn("release_year", F.col("release_year").cast("int")).write.parquet(second)
    both = incremental.Layout([*layout.bronze, second], layout.root)
    two = _run(spark, both, 2)
    assert (two.processed, two.inserted, two.updated) == (2, 2, 1)
    assert two.watermark > one.watermark

    titles = both.read(spark, "silver_titles_scd2")
    current = {r.show_id: (r.title, r.version_number) for r in titles.filter("is_current").collect()}
    assert current == {"s1": ("Title One Updated", 2), "s2": ("Title Two", 1), "s3": ("Title Three", 1)}
    countries = sorted(tuple(r) for r in both.read(spark, "silver_country").collect())
    assert countries == [("s1", "Canada"), ("s1", "United States"), ("s2", "India"), ("s3", "India")]
    facts = both.read(spark, "fact_content")
    assert facts.count() == 4

    three = _run(spark, both, 3)
    assert (three.status, three.processed, three.watermark) == ("SKIPPED", 0, two.watermark)
    assert both.read(spark, "silver_titles_scd2").count() == 4

    again = _run(spark, both, 4, full=True)  # every layer anew from all of bronze
    assert again.processed == 4 and again.inserted == 3 and again.updated == 0
    assert {r.version_number for r in both.read(spark, "silver_titles_scd2").collect()} == {1}
    runs = spark.read.parquet(both.metadata("pipeline_runs"))
    assert {r.pipeline_run_id: r.execution_status for r in runs.collect()} == {"r1": "SUCCESS", "r2": "SUCCESS", "r3": "SKIPPED", "r4": "SUCCESS"}
    steps = spark.read.parquet(both.metadata("pipeline_steps")).filter("pipeline_run_id = 'r2'")
    assert {r.pipeline_stage for r in steps.collect()} == {"Validation", "Silver_Cleansing", "SCD_Type1", "SCD_Type2", "Gold"}
    sizes = spark.read.parquet(both.metadata("dataset_metadata")).filter("pipeline_run_id = 'r2'")
    counted = {r.dataset_name: r.record_count for r in sizes.collect()}
    assert counted == {n: both.lake(spark).read(n, 2).count() for n in both.lake(spark).snapshot(2).tables} if 2 in both.lake(spark).versions() else counted
    assert counted["silver_titles_scd2"] == 4 and counted["fact_content"] == 4 and len(counted) == 19


def test_a_run_leaves_no_scratch(spark, layout, monkeypatch, tmp_path):
    monkeypatch.setattr(sinks, "workspace", lambda spark: str(tmp_path / "shared"))
    _run(spark, layout, 1)
    assert list((tmp_path / "shared").iterdir()) == []
    assert layout.read(spark, "silver_titles_scd2").count() == 2


def test_rejected_rows_are_gated_and_kept(spark, layout):
    rules = {"value_sets": {"type": ["Movie", "TV Show"]}, "completeness_checks": ["country"], "max_values": {"release_year": 2020}}
    gated = _run(spark, layout, 1, rules=rules)
    assert (gated.processed, gated.passed, gated.rejected, gated.inserted) == (2, 0, 2, 0)
    stored = spark.read.parquet(f"{layout.rejects}/rejected_batch_b1")
    assert {r.reason_for_failure for r in stored.collect()} == {"release_year cannot be in the future"}


def test_a_failed_run_is_recorded_and_leaves_the_watermark(spark, layout):
    with pytest.raises(Exception, match="no_such_column"):
        _run(spark, layout, 1, rules={"null_checks": ["no_such_column"]})
    run = spark.read.parquet(layout.metadata("pipeline_runs")).first()
    assert run.execution_status == "FAILED" and "no_such_column" in run.error_details
    assert incremental.read_watermark(spark, layout.metadata("watermarks"), layout.name) == incremental.EPOCH


def test_without_the_gate_rejects_reach_silver(spark, layout):
    open_gate = _run(spark, layout, 1, rules={"max_values": {"release_year": 2020}}, gate=False)
    assert (open_gate.rejected, open_gate.inserted) == (2, 2)


def test_watermark_log(spark, tmp_path):
    path = str(tmp_path / "marks")
    assert incremental.read_watermark(spark, path, "p") == incremental.EPOCH
    for n in (1, 3, 2):
        incremental.commit_watermark(
            spark, path, {"pipeline_name": "p", "last_processed_timestamp": datetime(2026, 1, n), "updated_at": datetime(2026, 2, n)}
        )
    assert incremental.read_watermark(spark, path, "p") == datetime(2026, 1, 3)
    assert incremental.read_watermark(spark, path, "other") == incremental.EPOCH


def test_sources_meet_on_their_common_columns(spark):
    a = spark.createDataFrame([(1, "x", 2020)], "id int, t string, release_year int")
    b = spark.createDataFrame([("2021", 2, 9.0)], "release_year string, id int, extra double")
    both = incremental.consolidate([a, b], "r9")
    assert set(both.columns) == {"id", "release_year", "pipeline_run_id", "source_system"}
    assert sorted((r.id, r.release_year) for r in both.collect()) == [(1, "2020"), (2, "2021")]
    assert set(incremental.consolidate([a, b], "r9", "outer").columns) == {"id", "t", "release_year", "extra", "pipeline_run_id", "source_system"}


def _stream(spark, tmp_path, layout, bronze, **more):
    merge = continuous.layers_merger(layout, "files", as_of=DAY, now=datetime(2026, 7, 20), **more)
    schema = spark.read.parquet(bronze).schema
    continuous.merge_batches(spark, bronze, schema, merge, str(tmp_path / "cp"), files_per_batch=1).awaitTermination()
    return layout.read(spark, "silver_titles_scd2")


def test_stream_of_files_equals_one_batch(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    for n in range(3):
        data = [_record(f"s{i}", f"Title {i} v{n}") for i in range(n, n + 4)]
        raw_frame(spark, data, datetime(2026, 7, 14 + n), f"b{n}").coalesce(1).write.mode("append").parquet(bronze)
    layout = incremental.Layout([], str(tmp_path / "lake"), buckets=4)
    current = {r.show_id: r.title for r in _stream(spark, tmp_path, layout, bronze).filter("is_current").collect()}
    batch = silver.build_silver(spark.read.parquet(bronze), DAY.year)
    assert current == {r.show_id: r.title for r in batch.titles.collect()}
    _equals_a_rebuild(spark, layout)
    before = _stream(spark, tmp_path, layout, bronze).count()
    version = layout.lake(spark).snapshot().version
    assert _stream(spark, tmp_path, layout, bronze).count() == before and layout.lake(spark).snapshot().version == version
    raw_frame(spark, [_record("s9", "New")], datetime(2026, 7, 30)).coalesce(1).write.mode("append").parquet(bronze)
    assert _stream(spark, tmp_path, layout, bronze).count() == before + 1
    assert layout.lake(spark).snapshot().state == {"stream files": 3}
    steps = spark.read.parquet(layout.metadata("pipeline_steps"))
    assert {r.pipeline_run_id for r in steps.collect()} == {f"files-{n}" for n in range(4)}
    assert layout.lake(spark).versions() == [3, 4]  # older versions are vacuumed


def test_a_stream_quarantines_and_judges(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    for n, data in enumerate([RAW, [_record("z1", "Fine"), _record("z2", "Too new")]]):
        df = raw_frame(spark, data, datetime(2026, 7, 14 + n)).withColumn("release_year", F.when(F.col("show_id") == "z2", "2031").otherwise(F.col("release_year")))
        df.coalesce(1).write.mode("append").parquet(bronze)
    layout = incremental.Layout([], str(tmp_path / "lake"))
    titles = _stream(spark, tmp_path, layout, bronze, rules={"max_values": {"release_year": 2030}})
    assert {r.show_id for r in titles.collect()} == {"m7", "m9", "t2", "z1"}
    unread = spark.read.option("recursiveFileLookup", "true").parquet(layout.unparsed)
    assert [(r.show_id, r.reason_for_failure) for r in unread.collect()] == [("x4", silver.DATE_REJECT)]
    broken = spark.read.option("recursiveFileLookup", "true").parquet(layout.rejects)
    assert [(r.show_id, r.reason_for_failure) for r in broken.collect()] == [("z2", "release_year cannot be in the future")]


def test_a_replayed_batch_is_passed_over(spark, tmp_path):
    """The stream dies after the merge is committed and before its own checkpoint, so the batch comes again."""
    bronze = str(tmp_path / "bronze")
    for n in range(2):
        raw_frame(spark, [_record("s1", f"Title v{n}")], datetime(2026, 7, 14 + n)).coalesce(1).write.mode("append").parquet(bronze)
    layout, merged = incremental.Layout([], str(tmp_path / "lake")), []
    merge = continuous.layers_merger(layout, "files", as_of=DAY, now=datetime(2026, 7, 20))

    def dies_once(batch, batch_id):
        merge(batch, batch_id)
        merged.append(batch_id)
        if len(merged) == 1:
            raise RuntimeError("dies before the checkpoint")

    def drain():
        continuous.merge_batches(spark, bronze, spark.read.parquet(bronze).schema, dies_once, str(tmp_path / "cp"), 1).awaitTermination()

    with pytest.raises(Exception, match="dies before the checkpoint"):
        drain()
    first = layout.lake(spark).snapshot()
    drain()
    assert merged == [0, 0, 1] and first.state == {"stream files": 0} and layout.lake(spark).snapshot().version == first.version + 1
    assert layout.read(spark, "silver_titles_scd2").count() == 2


def test_two_row_file_end_to_end(spark, layout):
    _run(spark, layout, 1)
    gold = {n: layout.read(spark, n).count() for n in ("dim_title", "fact_content", "kpi_country_summary")}
    assert gold == {"dim_title": 2, "fact_content": 2, "kpi_country_summary": 2}


STAR = ["fact_content", "dim_title", "dim_director", "dim_country", "dim_genre", "dim_rating", "dim_type", "dim_date"]
KPIS = ["kpi_content_summary", "kpi_country_summary", "kpi_genre_summary", "kpi_release_summary", "kpi_rating_summary"]


def _rows(df):
    keep = sorted(c for c in df.columns if c not in ("batch_id", "pipeline_run_id"))
    return sorted(str(tuple(r)) for r in df.select(*keep).collect())


def _equals_a_rebuild(spark, layout):
    stored = gold.read_star(layout.lake(spark))
    bridges = {b: layout.read(spark, b) for b in silver.BRIDGES}
    anew = star.build_star(layout.read(spark, "silver_titles_scd2"), bridges, "b", "r")
    assert _rows(stored.fact) == _rows(anew.fact)
    for name, dim in anew.dims.items():
        assert _rows(stored.dims[name]) == _rows(dim), name
    for name, kpi in star.kpi_tables(anew).items():
        assert _rows(layout.read(spark, name)) == _rows(kpi), name


def _bronze(spark, tmp_path, n, data):
    path = str(tmp_path / f"bronze_{n}")
    raw_frame(spark, data, datetime(2026, 7, 14 + n)).write.parquet(path)
    return path


def test_gold_after_deltas_equals_a_rebuild(spark, layout, tmp_path):
    """Inserts, changes, members that lose their last title, and titles that come again as they were."""
    _run(spark, layout, 1, full=True)
    _equals_a_rebuild(spark, layout)
    paths = list(layout.bronze)
    deltas = [
        [_record("s1", "Title One", "Peru"), ("s4", "TV Show", "Four", "D, E", "C", "Peru, Chad", "May 2, 2020", "1999", "R", "2 Seasons", "Dramas, Kids", "t")],
        [_record("s1", "Title One", "Peru"), _record("s2", "Renamed", "Chad")],
        [("s4", "Movie", "Four", "F", "C", "Chad", None, None, "R", "70 min", "Kids", "t"), (None, "Movie", "No key", "G", "C", "Oz", "May 2, 2020", "1999", "R", "1 min", "Kids", "t")],
        [(None, "Movie", "No key again", "H", "C", "Oz", "May 2, 2020", "1999", "R", "1 min", "Kids", "t")],
    ]
    for n, data in enumerate(deltas, 2):
        paths.append(_bronze(spark, tmp_path, n, data))
        assert _run(spark, incremental.Layout(paths, layout.root), n).status == "SUCCESS"
        _equals_a_rebuild(spark, layout)
    assert "United States" not in {r.country for r in layout.read(spark, "dim_country").collect()}
    assert {r.title: r.version_number for r in layout.read(spark, "silver_titles_scd2").filter("show_id IS NULL").collect()} == {"No key": 1, "No key again": 2}


def test_a_delta_leaves_other_buckets_alone(spark, tmp_path):
    data = [_record(f"s{i}", f"Title {i}", f"Land {i % 9}") for i in range(200)]
    first = incremental.Layout([_bronze(spark, tmp_path, 0, data)], str(tmp_path / "lake"), bucket_rows=10)
    _run(spark, first, 1, full=True)
    before = first.lake(spark).snapshot()
    second = incremental.Layout([*first.bronze, _bronze(spark, tmp_path, 1, [_record("s5", "New five", "Peru"), _record("s900", "New", "Peru")])], first.root, bucket_rows=10)
    _run(spark, second, 2)
    after = second.lake(spark).snapshot()
    for name in ("silver_titles_scd2", *silver.BRIDGES, "fact_content", "dim_title"):
        old, new = before.tables[name].parts, after.tables[name].parts
        assert before.tables[name].buckets == 20
        changed = {b for b in old.keys() | new.keys() if old.get(b) != new.get(b)}
        assert 0 < len(changed) <= 2, name
    assert before.tables["dim_rating"].parts != after.tables["dim_rating"].parts  # its use count
    _equals_a_rebuild(spark, second)


def test_full_drops_what_bronze_no_longer_holds(spark, layout, tmp_path):
    _run(spark, layout, 1, full=True)
    reader = layout.read(spark, "silver_titles_scd2")
    other = incremental.Layout([_bronze(spark, tmp_path, 2, [_record("s2", "Title Two", "Chad")])], layout.root)
    _run(spark, other, 2, full=True)
    assert reader.count() == 2  # a query that began before reads the old table whole
    assert {r.show_id for r in other.read(spark, "silver_titles_scd2").collect()} == {"s2"}
    assert {r.country for r in other.read(spark, "kpi_country_summary").collect()} == {"Chad"}
    _equals_a_rebuild(spark, other)


@pytest.mark.parametrize("dies_at", [1, 4, 9, 15, 18, None])
def test_a_run_that_dies_is_run_again(spark, layout, tmp_path, monkeypatch, dies_at):
    """At any of its writes, or in its commit: readers see the old lake whole, and the next run does the work once."""
    _run(spark, layout, 1)
    old = {n: _rows(layout.read(spark, n)) for n in ("silver_titles_scd2", *silver.BRIDGES, *STAR, *KPIS)}
    both = incremental.Layout([*layout.bronze, _bronze(spark, tmp_path, 1, [_record("s3", "Third", "Peru"), _record("s1", "Renamed", "Chad")])], layout.root)
    write, calls = snapshots.Change._write, []

    def dying(self, name, df, table):
        calls.append(name)
        if len(calls) == dies_at:
            raise RuntimeError("dies")
        return write(self, name, df, table)

    def no_commit(self):
        raise RuntimeError("dies")

    monkeypatch.setattr(snapshots.Change, "_write", dying)
    if dies_at is None:
        monkeypatch.setattr(snapshots.Change, "commit", no_commit)
    with pytest.raises(RuntimeError, match="dies"):
        _run(spark, both, 2)
    monkeypatch.undo()
    assert {n: _rows(layout.read(spark, n)) for n in old} == old
    if dies_at is not None:
        steps = spark.read.parquet(both.metadata("pipeline_steps")).filter("execution_status = 'FAILED'").collect()
        assert steps and all("dies" in r.error_message for r in steps)
    assert _run(spark, both, 2).status == "SUCCESS"
    titles = both.read(spark, "silver_titles_scd2")
    assert sorted((r.show_id, r.title, r.is_current) for r in titles.collect()) == [
        ("s1", "Renamed", True), ("s1", "Title One", False), ("s2", "Title Two", True), ("s3", "Third", True),
    ]
    _equals_a_rebuild(spark, both)
    assert both.lake(spark).vacuum(keep=2) == 0  # what the dead run wrote was dropped by the next one


def test_streamed_files_follow_the_rows_and_batches_stay_three(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(history, "FILE_ROWS", 200)
    layout = history._streamed.__wrapped__(spark.sparkContext.applicationId, sf)
    per_batch = math.ceil(lake.bronze(spark, sf).count() / 600)
    assert per_batch > 1 and len(glob.glob(f"{layout.root}/bronze/part-*.parquet")) == 3 * per_batch
    assert layout.lake(spark).snapshot().state["stream bronze"] == 2
    kept = layout.read(spark, "silver_titles_scd2").select("show_id")
    assert kept.count() == kept.distinct().count() == lake.titles(spark, sf).count()


def test_rows_without_rules_are_counted_and_not_written_again(spark, layout, monkeypatch):
    names, stage = [], sinks.stage
    monkeypatch.setattr(sinks, "stage", lambda df, name="stage": names.append(name) or stage(df, name))
    one = _run(spark, layout, 1, full=True)
    assert (one.processed, one.rejected, one.nulls_handled) == (2, 0, 0) and one.watermark is not None
    assert "cleaned" in names and "judged" not in names


def test_buckets_are_rewritten_a_few_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "SLICE", 2, raising=False)
    data = [_record(f"s{i}", f"Title {i}", f"Land {i % 9}, Peru") for i in range(200)]
    layout = incremental.Layout([_bronze(spark, tmp_path, 0, data)], str(tmp_path / "lake"), bucket_rows=40)
    _run(spark, layout, 1, full=True)
    sliced = {"r1": ["fact_content"], "r2": ["silver_titles_scd2", *silver.BRIDGES, "fact_content", "dim_title"]}
    _equals_a_rebuild(spark, layout)
    delta = [_record(f"s{i}", f"Title {i} again", f"Land {i % 5}") for i in range(100, 300)]
    both = incremental.Layout([*layout.bronze, _bronze(spark, tmp_path, 1, delta)], layout.root, bucket_rows=40)
    for n, run in enumerate(sliced, 1):
        if n == 2:
            _run(spark, both, 2)
            _equals_a_rebuild(spark, both)
        for name in sliced[run]:
            parts = both.lake(spark).snapshot().tables[name].parts
            writes = [p.split("/")[1] for p in parts.values()]
            assert len(parts) == 5 and max(map(writes.count, writes)) == 2, (run, name)


def test_shuffle_files_go_with_their_action(spark, tmp_path):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(files.length()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    with sinks.freeing(spark):
        kept = sinks.stage(spark.range(1000).repartition(7, "id").groupBy((F.col("id") % 5).alias("k")).count())
        deadline = time.time() + 30
        while shuffled() - before and time.time() < deadline:
            time.sleep(0.2)
        assert not shuffled() - before and kept.count() == 5
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == setting
