"""Sources, sinks and whole-table operators (S, U). Files go to the shared folder of the application."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from suite import lake
from suite.lake import over_fact, over_silver, table
from suite.registry import query
from terrace.operators import tables
from terrace.session import workspace
from terrace.sources import readers, sinks

NOW = datetime(2024, 2, 1, 12, 0, 0)


def _folder(spark, name: str) -> str:
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(spark, sf):
    customers = table(spark, sf, "customer")
    path = _folder(spark, "csv")
    customers.write.options(header="true", escape='"').csv(path)
    cfg = {"format": "csv", "path": path, "schema": readers.string_schema(customers.columns)}
    raw = readers.read_source(spark, cfg)
    return raw.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in customers.schema.fields))


@query("SELECT doc_id, md5(text) AS text_md5, lang FROM documents")
def csv_text_round_trip(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang")
    path = _folder(spark, "csvtext")
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    docs.write.options(header="true", escape='"', quoteAll="true", **keep).csv(path)
    cfg = {"format": "csv", "path": path, "schema": readers.string_schema(docs.columns), "options": {**keep, "multiLine": "true"}}
    return readers.read_source(spark, cfg).select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("text_md5"), "lang")


@query("SELECT * FROM part")
def json_round_trip(spark, sf):
    parts = table(spark, sf, "part")
    path = _folder(spark, "json")
    parts.write.json(path)
    # One object per line: the files stay splittable.
    return readers.read_source(spark, {"format": "json", "path": path, "schema": parts.schema})


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def xml_round_trip(spark, sf):
    suppliers = table(spark, sf, "supplier")
    path = _folder(spark, "xml")
    suppliers.write.format("xml").options(rootTag="suppliers", rowTag="supplier").save(path)
    return readers.read_source(spark, {"format": "xml", "path": path, "schema": suppliers.schema, "options": {"rowTag": "supplier"}})


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def payload_rows(spark, sf):
    return readers.payloads_to_df(table(spark, sf, "events"), "props", "k int", keep=["event_id"])


def _some_damaged(spark, sf):
    """Event bodies, every third cut short and every fifth missing."""
    body = F.when(F.col("event_id") % 5 == 0, None).when(F.col("event_id") % 3 == 0, F.expr("substring(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    return table(spark, sf, "events").select("event_id", body.alias("body"))


@query("SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN left(props, length(props) - 1) END AS body FROM events WHERE event_id % 5 = 0 OR event_id % 3 = 0")
def payloads_that_cannot_be_read(spark, sf):
    return readers.bad_payloads(_some_damaged(spark, sf), "body", "k int")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE event_id % 5 <> 0 AND event_id % 3 <> 0")
def payloads_read_beside_damaged_ones(spark, sf):
    return readers.payloads_to_df(_some_damaged(spark, sf), "body", "k int", keep=["event_id"])


@query(
    """
SELECT 'party_' || kind AS source, party_key, name FROM (
  SELECT 'csv' AS kind, CAST(c_custkey AS VARCHAR) AS party_key, c_name AS name FROM customer
  UNION ALL SELECT 'json', CAST(s_suppkey AS VARCHAR), s_name FROM supplier)"""
)
def ingested_sources(spark, sf):
    root = _folder(spark, "ingest")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("party_key"), F.col("c_name").alias("name"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("party_key"), F.col("s_name").alias("name"))
    customers.write.options(header="true").csv(f"{root}/in_csv")
    suppliers.write.json(f"{root}/in_json")
    schema = readers.string_schema(["party_key", "name"])
    cfg = {
        "name": "parties",
        "bronze_dir": f"{root}/bronze",
        "sources": {
            "party_csv": {"format": "csv", "path": f"{root}/in_csv", "schema": schema, "load_type": "FULL"},
            "party_json": {
                "format": "json", "path": f"{root}/in_json", "schema": schema, "load_type": "INCREMENTAL",
                "options": {"multiLine": "false"},
            },
        },
    }
    landed = readers.ingest(spark, cfg, "all", batch_id="b1", run_id="r1", now=NOW)
    return tables.labelled_union(
        {name: spark.read.parquet(path).select("party_key", "name") for name, path in landed.items()}, "source"
    )


@query(
    """
SELECT 'after_full' AS step, count(*) AS row_count FROM orders
UNION ALL SELECT 'after_append', 2 * count(*) FROM orders
UNION ALL SELECT 'after_second_full', count(*) FROM orders"""
)
def bronze_load_modes(spark, sf):
    path = _folder(spark, "modes")
    orders = tables.stamp_audit(
        table(spark, sf, "orders"), batch_id="b1", run_id="r1", source_system="orders", source_file=None, load_type="FULL", now=NOW
    )
    counts = {}
    for step, load in (("after_full", "FULL"), ("after_append", "INCREMENTAL"), ("after_second_full", "FULL")):
        sinks.write_bronze(orders, path, load)
        counts[step] = spark.read.parquet(path).count()
    return spark.createDataFrame(list(counts.items()), "step string, row_count long")


@query("SELECT event_type, count(*) AS row_count FROM events GROUP BY event_type")
def partitioned_events(spark, sf):
    path = _folder(spark, "parts")
    sinks.write_table(table(spark, sf, "events"), path, partition_by=["event_type"])
    return sinks.partition_counts(spark, path, "event_type")


@query(
    """
SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1998 THEN 'restated' ELSE o_orderpriority END AS o_orderpriority,
       CAST(year(o_orderdate) AS INTEGER) AS y FROM orders"""
)
def replaced_partitions(spark, sf):
    path = _folder(spark, "replace")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("y"))
    sinks.write_table(orders, path, partition_by=["y"])
    stored = spark.read.parquet(path)
    sinks.replace_partitions(stored.filter("y = 1998").withColumn("o_orderpriority", F.lit("restated")), path, ["y"])
    return spark.read.parquet(path)


UPSERT_SOURCE = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, 'RESTATED' AS c_mktsegment
FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 10000000 + s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier"""


def _upsert_source(spark, sf):
    overdrawn = table(spark, sf, "customer").filter("c_acctbal < 0")
    changed = overdrawn.withColumns({"c_acctbal": F.col("c_acctbal") + 100, "c_mktsegment": F.lit("RESTATED")})
    new = table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 10000000).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"), F.lit("x").alias("not_in_target"),
    )
    return changed.unionByName(new.drop("not_in_target"), allowMissingColumns=True)


@query(f"WITH src AS ({UPSERT_SOURCE}) SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM src) UNION ALL SELECT * FROM src")
def upserted_customers(spark, sf):
    return tables.upsert(table(spark, sf, "customer"), _upsert_source(spark, sf), ["c_custkey"])


@query(f"WITH src AS ({UPSERT_SOURCE}) SELECT * FROM customer UNION ALL SELECT * FROM src WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)")
def upserted_or_kept_customers(spark, sf):
    return tables.upsert(table(spark, sf, "customer"), _upsert_source(spark, sf), ["c_custkey"], "nothing")


@query(
    """
SELECT s_suppkey AS c_custkey, s_name AS c_name, s_nationkey AS c_nationkey, s_acctbal AS c_acctbal,
       nullif(CASE WHEN s_acctbal < 0 THEN '' ELSE 'OK' END, '') AS c_mktsegment FROM supplier"""
)
def aligned_suppliers(spark, sf):
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_name").alias("c_name"), F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"),
        F.col("s_nationkey").alias("c_nationkey"), F.when(F.col("s_acctbal") < 0, "").otherwise("OK").alias("c_mktsegment"),
        F.lit(1).alias("extra"),
    )
    return tables.blank_to_null(tables.align_to(suppliers, table(spark, sf, "customer").schema))


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1"""
)
def latest_order_lines(spark, sf):
    order = [F.desc("l_shipdate"), F.asc("l_partkey"), F.asc("l_suppkey"), F.asc("l_extendedprice")]
    latest = tables.latest_by_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], order)
    return latest.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


@query(
    over_fact(
        """
SELECT t.n AS titles_left, f.n AS facts_left FROM
 (SELECT count(*) AS n FROM silver_titles WHERE rating <> '5-LOW') t,
 (SELECT count(*) AS n FROM fact WHERE rating <> '5-LOW') f"""
    )
)
def cascaded_delete(spark, sf):
    star = lake.star(spark, sf)
    doomed = lake.titles(spark, sf).filter("rating = '5-LOW'").select("show_id")
    parents, facts = tables.delete_cascade(star.dims["dim_title"], star.fact, doomed, "show_id", "title_key")
    facts_left = facts.agg(F.count("*")).scalar()
    return parents.agg(F.count("*").alias("titles_left")).withColumn("facts_left", facts_left)


@query(
    over_silver(
        """
SELECT show_id, country FROM silver_country WHERE show_id NOT IN (SELECT show_id FROM silver_titles WHERE release_year = 2000)
UNION ALL SELECT show_id, genre FROM silver_genres WHERE show_id IN (SELECT show_id FROM silver_titles WHERE release_year = 2000)"""
    )
)
def replaced_bridge(spark, sf):
    bridges = lake.bridges(spark, sf)
    of_2000 = lake.titles(spark, sf).filter("release_year = 2000").select("show_id")
    incoming = tables.filtered_by(bridges["silver_genres"], of_2000, "show_id", "left_semi").withColumnRenamed("genre", "country")
    return tables.replace_bridge(bridges["silver_country"], incoming, "show_id")
