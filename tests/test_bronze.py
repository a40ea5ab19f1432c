from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from terrace.operators.tables import stamp_audit
from terrace.sources import readers, sinks

RAW_CSV = 'show_id,type,title,director,release_year\ns1,Movie,Test Movie 1,Director A,2026\ns2,TV Show,Test Show 2,,2025\n'
SCHEMA = readers.string_schema(["show_id", "type", "title", "director", "release_year"])
NOW = datetime(2026, 7, 14, 8, 30)


def _cfg(tmp_path, **source):
    return {"name": "catalog", "bronze_dir": str(tmp_path / "bronze"), "sources": {"titles": source}}


def test_landing_keeps_raw_columns_and_adds_seven(spark, tmp_path):
    (tmp_path / "titles.csv").write_text(RAW_CSV)
    cfg = _cfg(tmp_path, format="csv", path=str(tmp_path / "titles.csv"), schema=SCHEMA, load_type="FULL")
    landed = readers.ingest(spark, cfg, "titles", batch_id="b1", run_id="run-12345", now=NOW)
    df = spark.read.parquet(landed["titles"])
    assert df.count() == 2
    assert dict(df.dtypes) == {
        **{c: "string" for c in SCHEMA.names}, "batch_id": "string", "pipeline_run_id": "string",
        "ingestion_timestamp": "timestamp", "source_system": "string", "source_file": "string", "load_type": "string",
        "ingestion_date": "date",
    }
    row = df.filter("show_id = 's2'").first()
    assert (row.pipeline_run_id, row.load_type, row.source_system) == ("run-12345", "FULL", "catalog")
    assert row.director is None and row.ingestion_date == date(2026, 7, 14)
    assert (tmp_path / "bronze/bronze_titles/ingestion_date=2026-07-14").is_dir()


def test_full_replaces_and_incremental_appends(spark, tmp_path):
    df = stamp_audit(
        spark.range(10), batch_id="b", run_id="r", source_system="s", source_file="f", load_type="full", now=NOW
    )
    path = str(tmp_path / "t")
    for load, expected in (("FULL", 10), ("INCREMENTAL", 20), ("FULL", 10)):
        sinks.write_bronze(df, path, load)
        assert spark.read.parquet(path).count() == expected


def test_unknown_source_format_and_path(spark, tmp_path):
    cfg = _cfg(tmp_path, format="avro", path="x")
    with pytest.raises(readers.SourceError, match="unknown sources: other"):
        readers.pick_sources(cfg, "titles, other")
    with pytest.raises(readers.SourceError, match="unsupported"):
        readers.read_source(spark, cfg["sources"]["titles"])
    with pytest.raises(readers.SourceError, match="cannot read"):
        readers.read_source(spark, {"format": "csv", "path": str(tmp_path / "absent.csv"), "schema": SCHEMA})


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a,b\n1,"say ""hi"",\nthen go"\n2,\n')
    df = readers.read_source(spark, {"format": "csv", "path": str(tmp_path / "q.csv"), "schema": "a string, b string", "options": {"multiLine": "true"}})
    assert [tuple(r) for r in df.orderBy("a").collect()] == [("1", 'say "hi",\nthen go'), ("2", None)]


def test_json_array_and_xml_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"show_id": "s1", "title": "A"},\n {"show_id": "s2"}]')
    df = readers.read_source(spark, {"format": "json", "path": str(tmp_path / "a.json"), "schema": "show_id string, title string", "options": {"multiLine": "true"}})
    assert [tuple(r) for r in df.orderBy("show_id").collect()] == [("s1", "A"), ("s2", None)]
    (tmp_path / "a.xml").write_text("<shows><show><show_id>s1</show_id><title>A &amp; B</title></show><show><show_id>s2</show_id></show></shows>")
    cfg = {"format": "xml", "path": str(tmp_path / "a.xml"), "schema": "show_id string, title string", "options": {"rowTag": "show"}}
    assert [tuple(r) for r in readers.read_source(spark, cfg).orderBy("show_id").collect()] == [("s1", "A & B"), ("s2", None)]


def test_payloads_may_be_objects_or_arrays(spark):
    bodies = spark.createDataFrame([(1, '{"k": 5}'), (2, '[{"k": 6}, {"k": 7}]'), (3, "[]")], "id int, payload string")
    got = readers.payloads_to_df(bodies, "payload", "k int", keep=["id"])
    assert sorted(tuple(r) for r in got.collect()) == [(1, 5), (2, 6), (2, 7)]


def test_fetching_runs_a_given_function_per_url(spark):
    urls = spark.createDataFrame([("u1",), ("u2",)], "url string")
    bodies = readers.fetch_payloads(urls, lambda u: '[{"show_id": "%s"}]' % u)
    got = readers.payloads_to_df(bodies, "payload", "show_id string")
    assert sorted(r[0] for r in got.collect()) == ["u1", "u2"]


def test_jdbc_scan_is_split_over_tasks():
    opts = readers.jdbc_options(
        {
            "url": "jdbc:x", "table": "t", "connection_properties": {"user": "u", "driver": "d"},
            "partition_column": "id", "lower_bound": 0, "upper_bound": 900, "num_partitions": 9,
        }
    )
    assert opts["dbtable"] == "t" and opts["partitionColumn"] == "id" and opts["numPartitions"] == "9"
    assert "partitionColumn" not in readers.jdbc_options({"url": "jdbc:x", "table": "t"})


def test_lineage_can_name_each_rows_own_file(spark, tmp_path):
    spark.range(4).repartition(2).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    stamped = stamp_audit(df, batch_id="b", run_id="r", source_system="s", source_file=None, load_type="FULL", now=NOW)
    assert stamped.select("source_file").distinct().count() == 2
    assert stamped.filter(F.col("source_file").contains(str(tmp_path))).count() == 4


def test_bad_payloads_are_returned(spark):
    bodies = ["{bad", '[{"k": 1}, 5]', None, "[]", '{"k": 1}', "null", "", '[{"k": 1}', '[{"k": 2}, {"k": null}]']
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, payload string")
    assert sorted(r.id for r in readers.bad_payloads(df, "payload", "k int").collect()) == [0, 1, 2, 5, 6, 7]
    assert sorted((r.id, r.k) for r in readers.payloads_to_df(df, "payload", "k int", keep=["id"]).fillna(-1).collect()) == [(4, 1), (8, -1), (8, 2)]
