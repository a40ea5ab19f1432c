"""The test tables seen as a title catalog, and the layers derived from them.

Each order becomes one raw title record: its customer is the director, the
suppliers of its lines are the cast, their nations the countries and the part
types the genres. Some records carry planted defects (blank lists, a foreign
date format, a future year, repeats), chosen by order key. All orders and all
lines are used.

Derived layers are written once per application to the shared folder and read
from there by every query that needs them.
"""

from __future__ import annotations

import hashlib
from datetime import datetime
from functools import cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.tables import by_rows
from terrace.plans import silver as silver_layer
from terrace.plans import star as star_layer
from terrace.session import workspace
from terrace.sources import sinks

AS_OF_YEAR = 2003
BATCH, RUN = "batch-1", "run-1"
INGESTED = datetime(2024, 1, 1)
RATINGS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def raw_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The 12-column raw record, lazily."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey")
    suppliers = (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", "s_name", "n_name")
    )
    parts = table(spark, sf, "part").select("p_partkey", "p_type")
    joined = lines.join(by_rows(suppliers, table(spark, sf, "supplier")), F.col("l_suppkey") == F.col("s_suppkey"), "left").join(
        by_rows(parts), F.col("l_partkey") == F.col("p_partkey"), "left"
    )

    def listed(c: str):
        return F.array_join(F.sort_array(F.collect_set(c)), ", ")

    # Lines meet their order's others before lists are made: as names they take less shuffle than as lists of one or two.
    lists = joined.repartition("l_orderkey").groupBy("l_orderkey").agg(
        listed("s_name").alias("_cast"), listed("n_name").alias("_country"), listed("p_type").alias("_genres")
    )
    orders = table(spark, sf, "orders").join(
        by_rows(table(spark, sf, "customer").select("c_custkey", "c_name")), F.col("o_custkey") == F.col("c_custkey"), "left"
    )
    k = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    records = orders.join(lists.hint("merge"), k == F.col("l_orderkey"), "left").select(
        F.concat(F.lit("s"), k).alias("show_id"),
        F.when(status == "F", " movie ").when(status == "O", "TV Show").otherwise("MOVIE").alias("type"),
        F.concat(F.lit("Order  "), k, F.lit(" ")).alias("title"),
        F.when(k % 13 != 0, F.col("c_name")).alias("director"),
        F.col("_cast").alias("cast"),
        F.when(k % 17 == 0, F.lit(" ")).otherwise(F.col("_country")).alias("country"),
        F.when(k % 29 == 0, F.lit(None))
        .when(k % 23 == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(F.date_format("o_orderdate", "MMMM d, yyyy"))
        .alias("date_added"),
        F.when(k % 31 == 0, F.lit("2099")).otherwise(F.year("o_orderdate").cast("string")).alias("release_year"),
        F.when(k % 19 != 0, F.col("o_orderpriority")).alias("rating"),
        F.when(status == "O", F.concat((k % 9 + 1).cast("string"), F.lit(" Seasons")))
        .otherwise(F.concat((k % 180 + 30).cast("string"), F.lit(" min")))
        .alias("duration"),
        F.col("_genres").alias("listed_in"),
        F.concat(F.col("o_orderpriority"), F.lit(" order")).alias("description"),
        k.alias("_k"),
    )
    copies = F.when(F.col("_k") % 37 == 0, F.lit(2)).otherwise(F.lit(1))
    return records.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_k", "_copy")


def stamped(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "batch_id": F.lit(BATCH),
            "pipeline_run_id": F.lit(RUN),
            "ingestion_timestamp": F.lit(INGESTED).cast("timestamp"),
        }
    )


def _home(spark: SparkSession, sf: str) -> str:
    return f"{workspace(spark)}/lake-{hashlib.sha1(str(sf).encode()).hexdigest()[:12]}"


@cache
def _bronze_path(app: str, sf: str) -> str:
    spark = SparkSession.active()
    path = f"{_home(spark, sf)}/bronze"
    with sinks.short_shuffles(spark):
        sinks.write_table(stamped(raw_catalog(spark, sf)), path)
    return path


@cache
def _silver_path(app: str, sf: str) -> str:
    spark = SparkSession.active()
    path = f"{_home(spark, sf)}/silver"
    built = silver_layer.build_silver(bronze(spark, sf), AS_OF_YEAR, persist=lambda df: sinks.stage(df, "cleaned"))
    titles_job = partial(sinks.write_table, built.titles, f"{path}/silver_titles", partition_by=["release_year"])
    sinks.run_together([titles_job, *(partial(sinks.write_table, df, f"{path}/{n}") for n, df in built.bridges.items())])
    return path


@cache
def _gold_path(app: str, sf: str) -> str:
    spark = SparkSession.active()
    path = f"{_home(spark, sf)}/gold"
    star_layer.write_facts(star_layer.build_star(titles(spark, sf), bridges(spark, sf), BATCH, RUN), path)
    return path


def _app(spark: SparkSession) -> str:
    return spark.sparkContext.applicationId


def bronze_path(spark: SparkSession, sf: str) -> str:
    return _bronze_path(_app(spark), sf)


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(bronze_path(spark, sf))


def titles(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{_silver_path(_app(spark), sf)}/silver_titles")


def bridges(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    root = _silver_path(_app(spark), sf)
    return {b: spark.read.parquet(f"{root}/{b}") for b in silver_layer.BRIDGES}


def star(spark: SparkSession, sf: str) -> star_layer.Star:
    return star_layer.read_star(spark, _gold_path(_app(spark), sf))


# --- the same layers as SQL, for the checks -----------------------------------------------------

RAW_CTE = """
lists AS (
  SELECT l_orderkey,
         string_agg(DISTINCT s_name, ', ' ORDER BY s_name) AS cast_list,
         string_agg(DISTINCT n_name, ', ' ORDER BY n_name) AS country_list,
         string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS genre_list
  FROM lineitem
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey
),
raw AS (
  SELECT 's' || o_orderkey AS show_id,
         CASE o_orderstatus WHEN 'F' THEN ' movie ' WHEN 'O' THEN 'TV Show' ELSE 'MOVIE' END AS type,
         'Order  ' || o_orderkey || ' ' AS title,
         CASE WHEN o_orderkey % 13 <> 0 THEN c_name END AS director,
         cast_list AS "cast",
         CASE WHEN o_orderkey % 17 = 0 THEN ' ' ELSE country_list END AS country,
         CASE WHEN o_orderkey % 29 = 0 THEN NULL
              WHEN o_orderkey % 23 = 0 THEN strftime(o_orderdate, '%d/%m/%Y')
              ELSE strftime(o_orderdate, '%B %-d, %Y') END AS date_added,
         CASE WHEN o_orderkey % 31 = 0 THEN '2099' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS release_year,
         CASE WHEN o_orderkey % 19 <> 0 THEN o_orderpriority END AS rating,
         CASE WHEN o_orderstatus = 'O' THEN (o_orderkey % 9 + 1) || ' Seasons'
              ELSE (o_orderkey % 180 + 30) || ' min' END AS duration,
         genre_list AS listed_in,
         o_orderpriority || ' order' AS description
  FROM orders
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN lists ON o_orderkey = l_orderkey
  CROSS JOIN (SELECT unnest([1, 2]) AS copy) copies
  WHERE copy = 1 OR o_orderkey % 37 = 0
)"""

CLEAN_CTE = (
    RAW_CTE
    + r""",
unique_raw AS (SELECT DISTINCT * FROM raw),
squashed AS (
  SELECT show_id, trim(type) AS type, date_added, release_year, rating,
         trim(regexp_replace(title, '\s+', ' ', 'g')) AS title,
         trim(regexp_replace(director, '\s+', ' ', 'g')) AS director,
         trim(regexp_replace("cast", '\s+', ' ', 'g')) AS "cast",
         trim(regexp_replace(country, '\s+', ' ', 'g')) AS country,
         trim(regexp_replace(duration, '\s+', ' ', 'g')) AS duration,
         trim(regexp_replace(listed_in, '\s+', ' ', 'g')) AS listed_in,
         trim(regexp_replace(description, '\s+', ' ', 'g')) AS description
  FROM unique_raw
),
cleaned AS (
  SELECT show_id,
         CASE lower(type) WHEN 'tv show' THEN 'TV Show' WHEN 'movie' THEN 'Movie' END AS type,
         coalesce(nullif(title, ''), 'Unknown') AS title,
         coalesce(nullif(director, ''), 'Unknown Director') AS director,
         coalesce(nullif("cast", ''), 'Unknown Cast') AS "cast",
         coalesce(nullif(country, ''), 'Unknown Country') AS country,
         date_added,
         CAST(try_strptime(trim(date_added), '%B %-d, %Y') AS DATE) AS parsed_date,
         release_year,
         coalesce(nullif(trim(rating), ''), 'UR') AS rating,
         coalesce(nullif(duration, ''), '0 min') AS duration,
         coalesce(nullif(listed_in, ''), 'Unknown') AS listed_in,
         coalesce(nullif(description, ''), 'Unknown') AS description
  FROM squashed
)"""
)

SILVER_CTE = (
    CLEAN_CTE
    + r""",
valid AS (
  SELECT * FROM cleaned WHERE parsed_date IS NOT NULL OR date_added IS NULL OR trim(date_added) = ''
),
silver_titles AS (
  SELECT show_id, type, title, parsed_date AS date_added, TRY_CAST(release_year AS INTEGER) AS release_year,
         rating, duration, description,
         2003 - TRY_CAST(release_year AS INTEGER) AS content_age,
         CASE WHEN type = 'Movie' THEN TRY_CAST(regexp_extract(duration, '(\d+)\s*min', 1) AS INTEGER) END AS duration_minutes,
         CASE WHEN type = 'TV Show' THEN TRY_CAST(regexp_extract(duration, '(\d+)\s*Season', 1) AS INTEGER) END AS season_count,
         TRY_CAST(release_year AS INTEGER) >= 1998 AS is_recent_release
  FROM valid
),
country_items AS (SELECT show_id, trim(unnest(regexp_split_to_array(country, ',\s*'))) AS v FROM valid),
silver_country AS (
  SELECT show_id,
         array_to_string([upper(w[1]) || lower(w[2:]) for w in string_split(v, ' ')], ' ') AS country
  FROM country_items WHERE v <> ''
),
silver_genres AS (
  SELECT * FROM (SELECT show_id, trim(unnest(regexp_split_to_array(listed_in, ',\s*'))) AS genre FROM valid) WHERE genre <> ''
),
silver_directors AS (
  SELECT * FROM (SELECT show_id, trim(unnest(regexp_split_to_array(director, ',\s*'))) AS director FROM valid) WHERE director <> ''
),
silver_cast AS (
  SELECT * FROM (SELECT show_id, trim(unnest(regexp_split_to_array("cast", ',\s*'))) AS cast_member FROM valid) WHERE cast_member <> ''
)"""
)

# The fact on natural keys: a title key stands for its show_id and so on.
FACT_CTE = (
    SILVER_CTE
    + """,
fact AS (
  SELECT t.show_id, t.title, t.type, t.rating, t.date_added, t.release_year, t.content_age, t.duration_minutes, t.season_count,
         c.country, g.genre, d.director
  FROM silver_titles t
  JOIN silver_directors d ON t.show_id = d.show_id
  JOIN silver_genres g ON t.show_id = g.show_id
  JOIN silver_country c ON t.show_id = c.show_id
)"""
)


def over_raw(select: str) -> str:
    return f"WITH {RAW_CTE}\n{select}"


def over_clean(select: str) -> str:
    return f"WITH {CLEAN_CTE}\n{select}"


def over_silver(select: str) -> str:
    return f"WITH {SILVER_CTE}\n{select}"


def over_fact(select: str) -> str:
    return f"WITH {FACT_CTE}\n{select}"


def rounded(expr: str, digits: int) -> str:
    """Half-up decimal rounding as a double, like ``round_to``."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"
