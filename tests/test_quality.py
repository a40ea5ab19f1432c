from datetime import datetime

import pytest
from pyspark.sql import Observation

from terrace.operators import quality
from terrace.sources import sinks

COLUMNS = ["show_id", "type", "title", "country", "date_added", "release_year", "rating", "duration", "description"]
RULES = {
    "required_columns": COLUMNS,
    "null_checks": ["show_id", "title", "type", "release_year"],
    "unique_checks": ["show_id"],
    "type_checks": {"release_year": "string"},
    "integer_columns": ["release_year"],
    "date_columns": {"date_added": "MMMM d, yyyy"},
    "value_sets": {"type": ["Movie", "TV Show"], "rating": ["PG", "R"]},
    "ranges": {"release_year": (1800, 2026)},
    "max_values": {"release_year": 2026},
    "not_blank": ["duration"],
    "min_lengths": {"title": 1},
    "completeness_checks": ["country", "description"],
}
GOOD = ("s100", "Movie", "Fine", "India", "September 25, 2021", "2021", "PG", "90 min", "text")


def _row(**changes):
    return tuple({**dict(zip(COLUMNS, GOOD)), **changes}[c] for c in COLUMNS)


@pytest.fixture
def frame(spark):
    data = [
        GOOD,
        _row(show_id="s101", title=None),
        _row(show_id="s102", type="Game"),
        _row(show_id="s103", release_year="2028"),
        _row(show_id="s104", country=""),
    ]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in COLUMNS))


def test_split_names_every_reason(spark, frame, tmp_path):
    seen = Observation()
    passed, rejected = quality.dq_split(frame, RULES, seen)
    reasons = {r.show_id: r.reason_for_failure for r in rejected.collect()}
    assert [r.show_id for r in passed.collect()] == ["s100"]
    assert "Null value in required column 'title'" in reasons["s101"]
    assert "Invalid type" in reasons["s102"]
    assert "release_year cannot be in the future" in reasons["s103"]
    assert "Required field 'country' is blank or empty" in reasons["s104"]
    assert seen.get == {"passed": 1, "rejected": 4}
    path = sinks.write_rejects(rejected, str(tmp_path), "batch-999", datetime(2026, 7, 14))
    stored = spark.read.parquet(path)
    assert stored.count() == 4
    assert {(r.batch_id, r.validation_timestamp) for r in stored.collect()} == {("batch-999", datetime(2026, 7, 14))}


def test_suite_totals(frame):
    suite = quality.run_suite(frame, RULES)
    summary = quality.suite_summary(suite).first()
    assert summary.success is False
    failed = {(r.expectation, r.column_name): r.failed for r in suite.collect() if not r.success}
    assert failed == {("not_null", "title"): 1, ("in_set", "type"): 1, ("between", "release_year"): 1, ("complete", "country"): 1}
    assert summary.evaluated_expectations == summary.successful_expectations + 4


def test_clean_frame_passes(frame):
    suite = quality.run_suite(frame.filter("show_id = 's100'"), RULES)
    assert quality.suite_summary(suite).first().success is True


def test_null_keys_are_never_duplicates(spark):
    data = [_row(show_id=None), _row(show_id=None), _row(show_id="a"), _row(show_id="a"), _row(show_id="b")]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in COLUMNS))
    judged = quality.with_reasons(df, RULES).collect()
    marked = sorted((str(r.show_id), "Duplicate show_id key value" in r.reasons) for r in judged)
    assert marked == [("None", False), ("None", False), ("a", True), ("a", True), ("b", False)]
    assert {r.failed for r in quality.run_suite(df, {"unique_checks": ["show_id"]}).collect()} == {2}


def test_unparsable_values_are_reported_not_raised(spark):
    df = spark.createDataFrame([_row(date_added="24/09/2021", release_year="next year")], ", ".join(f"{c} string" for c in COLUMNS))
    reasons = quality.with_reasons(df, RULES).first().reasons
    assert reasons == ["release_year datatype is not castable to integer", "date_added has invalid date format"]


def test_column_set_difference(frame):
    diff = quality.column_set_check(frame.drop("rating").withColumnRenamed("title", "name"), COLUMNS, ignore=["name"])
    assert diff == {"missing": ["title", "rating"], "unexpected": []}


def test_reason_breakdown_and_constraints(spark, frame):
    _, rejected = quality.dq_split(frame, RULES)
    assert {r.rejected_rows for r in quality.reason_breakdown(rejected).collect()} == {1}
    fact = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,)], "k int")
    dim = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    assert quality.orphan_counts(fact, {"d": (dim, "k")}).first().violations == 2
    assert quality.uniqueness_counts({"d": (dim, ["k"])}).first().violations == 1
