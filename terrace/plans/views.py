"""KPI views at title grain over the star."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.predicates import apply_filters, without
from terrace.functions.ratios import ratio_pct, round_to
from terrace.operators import ranking, rollups
from terrace.operators.tables import by_rows
from terrace.plans.star import Star

FILTER_COLUMNS = {"country": "country", "genre": "genre", "type": "type", "year": "release_year"}


def _type_flags(prefix: str = "total_", suffix: str = "") -> dict:
    return {
        f"{prefix}movies{suffix}": F.col("type") == "Movie",
        f"{prefix}tv_shows{suffix}": F.col("type") == "TV Show",
    }


def with_attributes(star: Star, *attributes: str) -> DataFrame:
    """The fact with natural attributes from its dimensions.

    Dimensions join by surrogate key; those of few counted rows are
    broadcast, large ones sort-merge.
    """
    df = star.fact
    for a in attributes:
        df = df.join(by_rows(star.dims[f"dim_{a}"].select(f"{a}_key", a)), f"{a}_key")
    return df


def _needed(context: Mapping[str, Any] | None, *always: str) -> list[str]:
    wanted = {a for a in ("country", "genre", "type") if (context or {}).get(a)}
    return list(dict.fromkeys([*always, *sorted(wanted)]))


def general_summary(star: Star) -> DataFrame:
    """K1: distinct titles by type, and the average age over distinct (title, age) pairs."""
    titles = with_attributes(star, "type")
    totals = rollups.entity_rollup(titles, [], "title_key", _type_flags(), out="total_titles")
    age = rollups.grain_average(star.fact, "title_key", "content_age", "average_content_age").scalar()
    return totals.withColumn("average_content_age", age)


def _per_member(star: Star, attribute: str, sentinel: str | None, out: str) -> DataFrame:
    """Distinct titles per member: count per surrogate key first, name the members afterwards."""
    counted = rollups.entity_rollup(star.fact, [f"{attribute}_key"], "title_key")
    named = counted.join(by_rows(star.dims[f"dim_{attribute}"]), f"{attribute}_key").select(F.col(attribute).alias(out), "titles_count")
    return without(named, out, sentinel) if sentinel else named


def country_distribution(star: Star) -> DataFrame:
    """K2: titles per country and its share of all country assignments."""
    return rollups.share_of_total(_per_member(star, "country", "Unknown Country", "country_name"), "titles_count")


def genre_distribution(star: Star) -> DataFrame:
    """K3"""
    return _per_member(star, "genre", "Unknown", "genre_name")


def director_distribution(star: Star) -> DataFrame:
    """K4"""
    return _per_member(star, "director", "Unknown Director", "director_name")


def rating_distribution(star: Star) -> DataFrame:
    """K5"""
    return _per_member(star, "rating", None, "rating_name")


def release_trends(star: Star) -> DataFrame:
    """K6: titles per release year and type."""
    counted = rollups.entity_rollup(star.fact, ["release_year", "type_key"], "title_key", out="releases_count")
    named = counted.join(star.dims["dim_type"], "type_key")
    return named.select("release_year", F.col("type").alias("type_name"), "releases_count")


def filtered_summary(star: Star, context: Mapping[str, Any]) -> DataFrame:
    """K7: the summary under optional filters; the average age is over fact rows, as the context query defines it."""
    df = apply_filters(with_attributes(star, *_needed(context, "type")), context, FILTER_COLUMNS)
    averages = {"average_content_age": ("content_age", 1)}
    return rollups.entity_rollup(df, [], "title_key", _type_flags(), averages, out="total_titles")


def filtered_genres(star: Star, context: Mapping[str, Any], n: int = 10) -> DataFrame:
    """K8: the top genres under optional filters, names breaking ties."""
    df = apply_filters(with_attributes(star, *_needed(context, "genre")), context, FILTER_COLUMNS)
    counted = rollups.entity_rollup(without(df, "genre", "Unknown"), ["genre"], "title_key")
    named = counted.withColumnRenamed("genre", "genre_name")
    return ranking.top_n(named, [F.desc("titles_count"), F.asc("genre_name")], n)


def yearly_trend(star: Star, first: int | None = None, last: int | None = None, context: Mapping[str, Any] | None = None) -> DataFrame:
    """K9: titles per year, all years or those of a range, with counts by type."""
    bounds = {"start_year": first, "end_year": last}
    span = {**(context or {}), **{k: v for k, v in bounds.items() if v is not None}}
    df = apply_filters(with_attributes(star, *_needed(context, "type")), span, FILTER_COLUMNS)
    flags = {"movie_releases": F.col("type") == "Movie", "tv_releases": F.col("type") == "TV Show"}
    return rollups.entity_rollup(df, ["release_year"], "title_key", flags, out="total_releases").orderBy("release_year")


def country_profile(star: Star, min_titles: int = 10, context: Mapping[str, Any] | None = None) -> DataFrame:
    """The feature table of the statistics: counts, type counts and fact-grain averages per country."""
    df = apply_filters(with_attributes(star, *_needed(context, "country", "type")), context, FILTER_COLUMNS)
    flags = {"movie_count": F.col("type") == "Movie", "tv_count": F.col("type") == "TV Show"}
    averages = {"avg_movie_duration": ("duration_minutes", 1), "avg_content_age": ("content_age", 1)}
    profile = rollups.entity_rollup(without(df, "country", "Unknown Country"), ["country"], "title_key", flags, averages)
    return profile.filter(F.col("titles_count") >= min_titles).withColumnRenamed("country", "country_name")


def executive_row(titles: DataFrame, star: Star) -> DataFrame:
    """Totals, ratios, average age and the top country, genre and director in one row."""
    movie, show = F.col("type") == "Movie", F.col("type") == "TV Show"

    def leader(df: DataFrame, name: str):
        return ranking.top_n(df, [F.desc("titles_count"), F.asc(name)], 1).select(name).scalar()

    per_title = rollups.entity_rollup(titles, [], "show_id", {"total_movies": movie, "total_tv_shows": show}, out="total_titles")
    age = titles.agg(round_to(F.avg("content_age"), 1)).scalar()
    return per_title.select(
        "total_titles",
        "total_movies",
        "total_tv_shows",
        age.alias("average_content_age"),
        ratio_pct(F.col("total_movies"), F.col("total_titles")).alias("movie_ratio_pct"),
        ratio_pct(F.col("total_tv_shows"), F.col("total_titles")).alias("tv_ratio_pct"),
        leader(country_distribution(star), "country_name").alias("top_country"),
        leader(genre_distribution(star), "genre_name").alias("top_genre"),
        leader(director_distribution(star), "director_name").alias("top_director"),
    )


def detail_listing(star: Star, n: int = 15) -> DataFrame:
    """Newest fact rows with their natural attributes."""
    # Titles first, while the facts that are shuffled for it hold keys only.
    titled = star.fact.join(by_rows(star.dims["dim_title"].select("title_key", "title")), "title_key")
    df = with_attributes(Star(titled, star.dims), "country", "genre", "type")
    picked = df.select("title", "type", "country", "genre", "release_year", "duration_minutes")
    order = [F.desc_nulls_last("release_year"), F.asc("title"), F.asc("country"), F.asc("genre")]
    return ranking.top_n(picked, order, n)


VIEWS = {
    "v_kpi_general_summary": general_summary,
    "v_kpi_country_distribution": country_distribution,
    "v_kpi_genre_distribution": genre_distribution,
    "v_kpi_top_directors": director_distribution,
    "v_kpi_rating_distribution": rating_distribution,
    "v_kpi_release_trends": release_trends,
}


def register_views(spark: SparkSession, star: Star, silver: Mapping[str, DataFrame] | None = None) -> list[str]:
    """K1-K6 and the tables themselves as temporary views for ad-hoc SQL."""
    frames = {**(silver or {}), **star.dims, "fact_content": star.fact, **{n: build(star) for n, build in VIEWS.items()}}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)
