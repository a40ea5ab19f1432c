"""Business transforms over silver."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions import calendar, labels
from terrace.operators import ranking, rollups
from terrace.operators.scd import current_view, has_versions
from terrace.operators.tables import by_rows
from terrace.plans.star import classic_columns
from terrace.sources.sinks import run_together, write_table


def kinds() -> dict:
    """Conditions for the two title types."""
    return {"movies": F.col("type") == "Movie", "tv_shows": F.col("type") == "TV Show"}


def enrich_titles(titles: DataFrame) -> DataFrame:
    """Decade, classic flag and category, and a type-dependent length band."""
    minutes, seasons = F.col("duration_minutes"), F.col("season_count")
    movie = labels.bands(minutes, labels.below(minutes, (60, "Short (<60m)"), (120, "Medium (60m-120m)")), "Long (>120m)")
    show = labels.bands(
        seasons, [(seasons == 1, "Single Season"), (seasons <= 3, "Mid-Length Series")], "Long Running Series"
    )
    return titles.withColumns(
        {
            "release_decade": calendar.decade_label(F.col("release_year")),
            **classic_columns(),
            "duration_bucket": F.when(F.col("type") == "Movie", movie).otherwise(show),
        }
    )


def kpi_summary(titles: DataFrame) -> DataFrame:
    """A1: totals, averages and ratios in one row."""
    averages = {"avg_movie_duration_mins": ("duration_minutes", 2), "avg_tv_seasons": ("season_count", 2)}
    return rollups.content_summary(titles, kinds(), averages, ratios=True)


def distribution(titles: DataFrame, bridge: DataFrame, value: str) -> DataFrame:
    """A2: titles per list value with counts by type, largest first."""
    joined = titles.select("show_id", "type").join(by_rows(bridge), "show_id")
    return rollups.count_by(joined, [value], kinds=kinds()).orderBy(F.desc("total_content"), value)


def rating_distribution(titles: DataFrame) -> DataFrame:
    return rollups.count_by(titles, ["rating"]).orderBy(F.desc("total_content"), "rating")


def top_genres_by_country(titles: DataFrame, country: DataFrame, genres: DataFrame, n: int = 3) -> DataFrame:
    """The genres ranked up to ``n`` in each country, ties kept."""
    pairs = titles.select("show_id").join(by_rows(country), "show_id").join(by_rows(genres), "show_id")
    counted = rollups.count_by(pairs, ["country", "genre"], "genre_count")
    return ranking.top_n_per_group(counted, ["country"], [F.desc("genre_count")], n, "genre_rank")


def director_rankings(titles: DataFrame, directors: DataFrame) -> DataFrame:
    """Directors by number of titles, names breaking ties."""
    known = directors.filter(F.col("director") != "Unknown Director")
    counted = rollups.count_by(titles.select("show_id").join(by_rows(known), "show_id"), ["director"], "title_count")
    return ranking.global_rank(counted, [F.desc("title_count"), F.asc("director")], "director_rank")


def yearly_releases(titles: DataFrame) -> DataFrame:
    """Releases per year with running total and growth. The windows see one row per year."""
    yearly = rollups.count_by(titles, ["release_year"], "yearly_releases")
    running = ranking.running_total(yearly, "release_year", "yearly_releases", "running_total_releases", bounded=True)
    return ranking.growth(running, "release_year", "yearly_releases", "yearly_growth_pct", bounded=True)


def transforms(titles: DataFrame, bridges: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The whole bundle over one set of silver tables."""
    if has_versions(titles):
        titles = current_view(titles)
    country, genres, directors = (bridges[b] for b in ("silver_country", "silver_genres", "silver_directors"))
    return {
        "kpi_summary": kpi_summary(titles),
        "country_distribution": distribution(titles, country, "country"),
        "genre_distribution": distribution(titles, genres, "genre"),
        "rating_distribution": rating_distribution(titles),
        "top_genres_by_country": top_genres_by_country(titles, country, genres),
        "director_rankings": director_rankings(titles, directors),
        "yearly_releases_summary": yearly_releases(titles),
        "gold_titles_enriched": enrich_titles(titles),
    }


def run_business_transforms(titles: DataFrame, bridges: Mapping[str, DataFrame], gold_dir: str) -> None:
    """Compute and write every output, the enriched titles by release year."""
    partitions = {"gold_titles_enriched": ["release_year"]}
    run_together(
        partial(write_table, df, f"{gold_dir}/{name}", partition_by=partitions.get(name, []))
        for name, df in transforms(titles, bridges).items()
    )
