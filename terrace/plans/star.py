"""Gold layer: dimensions, fact and KPI tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions import calendar, labels
from terrace.functions.keys import surrogate_key
from terrace.functions.ratios import round_to
from terrace.operators import quality
from terrace.operators.scd import current_view, has_versions
from terrace.operators.tables import add_default_member, by_rows
from terrace.sources.sinks import run_together, write_table

CLASSIC_BEFORE = 2000


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    dims: Mapping[str, DataFrame]


def build_dim(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Distinct members of one attribute under a hashed key."""
    return df.select(col).distinct().select(surrogate_key(col).alias(f"{name or col}_key"), col)


def classic_columns(year: str = "release_year") -> dict:
    """Classic flag and category."""
    classic = F.col(year) < CLASSIC_BEFORE
    return {"is_classic": classic, "content_category": labels.two_way(classic, "Classic", "Modern")}


def build_dim_title(titles: DataFrame) -> DataFrame:
    """G1: one row per distinct title description."""
    return (
        titles.withColumns(classic_columns())
        .select(surrogate_key("show_id").alias("title_key"), "show_id", "title", "description", "is_classic", "content_category")
        .distinct()
    )


def build_dim_date(titles: DataFrame, col: str = "date_added") -> DataFrame:
    """Calendar of the days that occur, plus the unknown member -1."""
    days = titles.select(col).filter(F.col(col).isNotNull()).distinct()
    dim = days.select(
        calendar.date_key(F.col(col)).alias("date_key"),
        F.col(col),
        *(c.alias(name) for name, c in calendar.calendar_columns(F.col(col)).items()),
    )
    return add_default_member(dim, {"date_key": calendar.UNKNOWN_DATE_KEY})


def build_fact(titles: DataFrame, country: DataFrame, genres: DataFrame, directors: DataFrame, batch_id: str, run_id: str) -> DataFrame:
    """One row per title, country, genre and director.

    All joins share the title key, so the chain keeps one partitioning; the
    narrowest bridge goes first to let rows multiply late.
    """
    spread = titles.join(by_rows(directors), "show_id").join(by_rows(genres), "show_id").join(by_rows(country), "show_id")
    return spread.select(
        surrogate_key("show_id").alias("title_key"),
        *(surrogate_key(c).alias(f"{c}_key") for c in ("director", "country", "genre", "rating", "type")),
        calendar.date_key(F.col("date_added")).alias("date_key"),
        "duration_minutes",
        "season_count",
        "release_year",
        "content_age",
        F.lit(batch_id).alias("batch_id"),
        F.lit(run_id).alias("pipeline_run_id"),
        "ingestion_timestamp",
    )


def build_star(
    titles: DataFrame, bridges: Mapping[str, DataFrame], batch_id: str, run_id: str, current_only: bool = True
) -> Star:
    """All dimensions and the fact. ``current_only=False`` keeps every title version."""
    if current_only and has_versions(titles):
        titles = current_view(titles)
    country, genres, directors = (bridges[b] for b in ("silver_country", "silver_genres", "silver_directors"))
    dims = {
        "dim_title": build_dim_title(titles),
        "dim_director": build_dim(directors, "director"),
        "dim_country": build_dim(country, "country"),
        "dim_genre": build_dim(genres, "genre"),
        "dim_rating": build_dim(titles, "rating"),
        "dim_type": build_dim(titles, "type"),
        "dim_date": build_dim_date(titles),
    }
    return Star(build_fact(titles, country, genres, directors, batch_id, run_id), dims)


def kpi_tables(star: Star) -> dict[str, DataFrame]:
    """KPI tables at fact grain: they count fact rows, not titles.

    Facts are counted per surrogate key before the dimension is joined, so the
    join sees one row per member.
    """
    fact = star.fact

    def per_member(dim: str, attribute: str) -> DataFrame:
        counted = fact.groupBy(f"{attribute}_key").agg(F.count("title_key").alias("total_content"))
        named = counted.join(by_rows(star.dims[dim]), f"{attribute}_key").select(attribute, "total_content")
        return named.orderBy(F.desc("total_content"), attribute)

    kind = F.col("type_key")
    summary = fact.agg(
        F.count("title_key").alias("total_records"),
        F.count_if(kind == surrogate_key(F.lit("Movie"))).alias("total_movies"),
        F.count_if(kind == surrogate_key(F.lit("TV Show"))).alias("total_tv_shows"),
        round_to(F.avg("duration_minutes"), 2).alias("avg_movie_duration_mins"),
        round_to(F.avg("season_count"), 2).alias("avg_tv_seasons"),
    )
    return {
        "kpi_content_summary": summary,
        "kpi_country_summary": per_member("dim_country", "country"),
        "kpi_genre_summary": per_member("dim_genre", "genre"),
        "kpi_release_summary": fact.groupBy("release_year").agg(F.count("title_key").alias("yearly_releases")).orderBy("release_year"),
        "kpi_rating_summary": per_member("dim_rating", "rating"),
    }


def write_star(star: Star, gold_dir: str) -> Star:
    """Write dimensions, the fact by release year and the KPI tables; returns the star as stored."""
    stored = write_facts(star, gold_dir)
    run_together(partial(write_table, kpi, f"{gold_dir}/{name}") for name, kpi in kpi_tables(stored).items())
    return stored


def write_facts(star: Star, gold_dir: str) -> Star:
    """Write dimensions and fact; returns the star as stored."""
    fact = partial(write_table, star.fact, f"{gold_dir}/fact_content", partition_by=["release_year"])
    run_together([fact, *(partial(write_table, dim, f"{gold_dir}/{name}") for name, dim in star.dims.items())])
    return read_star(star.fact.sparkSession, gold_dir)


# The dimensions of the star.
DIMENSIONS = ["dim_title", "dim_director", "dim_country", "dim_genre", "dim_rating", "dim_type", "dim_date"]


def read_star(spark, gold_dir: str) -> Star:
    dims = {name: spark.read.parquet(f"{gold_dir}/{name}") for name in DIMENSIONS}
    return Star(spark.read.parquet(f"{gold_dir}/fact_content"), dims)


def integrity_report(star: Star, bridges: Mapping[str, DataFrame], titles: DataFrame) -> DataFrame:
    """Q12: violations of the keys and foreign keys a database would enforce."""
    dims = {name.removeprefix("dim_"): (dim, f"{name.removeprefix('dim_')}_key") for name, dim in star.dims.items()}
    foreign = quality.orphan_counts(star.fact, {f"fact_{n}": d for n, d in dims.items()})
    unique = quality.uniqueness_counts({f"dim_{n}": (d, [k]) for n, (d, k) in dims.items()})
    for name, bridge in bridges.items():
        foreign = foreign.unionByName(quality.orphan_counts(bridge, {name: (titles, "show_id")}))
        unique = unique.unionByName(quality.uniqueness_counts({name: (bridge, bridge.columns)}))
    return foreign.unionByName(unique)
