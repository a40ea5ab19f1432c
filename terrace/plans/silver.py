"""Silver layer: cleaning, enrichment and bridge tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import calendar, text
from terrace.operators.tables import explode_list, latest_by_key

# The raw record and the defaults its blanks take.
RAW_COLUMNS = [
    "show_id", "type", "title", "director", "cast", "country", "date_added",
    "release_year", "rating", "duration", "listed_in", "description",
]
TEXT_COLUMNS = ["title", "director", "cast", "country", "duration", "listed_in", "description"]
BLANK_DEFAULTS = {
    "director": "Unknown Director",
    "cast": "Unknown Cast",
    "country": "Unknown Country",
    "rating": "UR",
    "duration": "0 min",
}
TYPES = ["Movie", "TV Show"]
TITLE_COLUMNS = [
    "show_id", "type", "title", "date_added", "release_year", "rating", "duration", "description",
    "content_age", "duration_minutes", "season_count", "is_recent_release",
    "batch_id", "pipeline_run_id", "ingestion_timestamp",
]
DATE_REJECT = "Unparseable date_added format"

# bridge table -> (list column, value column, initcap)
BRIDGES = {
    "silver_country": ("country", "country", True),
    "silver_genres": ("listed_in", "genre", False),
    "silver_directors": ("director", "director", False),
    "silver_cast": ("cast", "cast_member", False),
}


@dataclass(frozen=True)
class Silver:
    """One cleaned batch: titles, its bridges, and the rows whose date did not parse."""

    titles: DataFrame
    bridges: Mapping[str, DataFrame]
    rejects: DataFrame


def clean(raw: DataFrame, defaults: Mapping[str, str] = BLANK_DEFAULTS) -> DataFrame:
    """Text squashed and defaulted, type canonical, rating defaulted, date parsed into ``parsed_date``."""
    tidy: dict[str, Column] = {c: text.fill_blank(F.col(c), defaults.get(c, "Unknown")) for c in TEXT_COLUMNS}
    tidy["type"] = text.canonicalize(F.col("type"), TYPES)
    tidy["rating"] = F.trim(text.fill_blank(F.col("rating"), defaults.get("rating", "UR")))
    tidy["parsed_date"] = text.parse_date(F.col("date_added"))
    # Squashed in a step of its own, so that each text is squashed once and not for the test and again for the value.
    return raw.withColumns({c: text.squash_space(F.col(c)) for c in TEXT_COLUMNS}).withColumns(tidy)


def enrich(cleaned: DataFrame, as_of_year: int) -> DataFrame:
    """Typed release year, age, recency, minutes and seasons."""
    year = text.safe_int(F.col("release_year"))
    typed = cleaned.withColumn("release_year", year)
    return typed.withColumns(
        {
            "content_age": calendar.age_in_years(F.col("release_year"), as_of_year),
            "is_recent_release": calendar.is_recent(F.col("release_year"), as_of_year),
            "duration_minutes": text.parse_quantity(F.col("duration"), "min", F.col("type") == "Movie"),
            "season_count": text.parse_quantity(F.col("duration"), "Season", F.col("type") == "TV Show"),
        }
    )


def newest_first(df: DataFrame) -> list[Column]:
    """Total order for de-duplication: latest ingestion, then the whole row."""
    stamp = [F.col("ingestion_timestamp").desc_nulls_last()] if "ingestion_timestamp" in df.columns else []
    return stamp + [F.col(c).asc_nulls_last() for c in df.columns if c not in ("show_id", "ingestion_timestamp")]


def build_silver(
    bronze: DataFrame,
    as_of_year: int,
    defaults: Mapping[str, str] = BLANK_DEFAULTS,
    order: Sequence[Column] | None = None,
    persist: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Silver:
    """Bronze rows to silver frames.

    The cleaned rows feed every table; ``persist`` may write them once (a
    pipeline stages them), by default everything stays lazy.
    """
    unique = latest_by_key(bronze, ["show_id"], list(order) if order else newest_first(bronze))
    cleaned = persist(clean(unique, defaults))
    bad_date = text.unparsed(F.col("date_added"), F.col("parsed_date"))
    valid = enrich(cleaned.filter(~bad_date), as_of_year)
    titles = valid.withColumn("date_added", F.col("parsed_date")).select(*TITLE_COLUMNS)
    bridges = {
        name: explode_list(valid, "show_id", source, out, cap) for name, (source, out, cap) in BRIDGES.items()
    }
    rejects = cleaned.filter(bad_date).drop("parsed_date").withColumn("reason_for_failure", F.lit(DATE_REJECT))
    return Silver(titles, bridges, rejects)


def silver_metrics(bronze: DataFrame) -> DataFrame:
    """Received, duplicates removed, nulls handled, failed dates and written, in one pass as one row.

    The counts describe exactly what :func:`build_silver` keeps: duplicates
    are rows beyond one per key, the rest is measured on the kept row.
    """
    keyed = bronze.groupBy("show_id").agg(F.count("*").alias("_n"))
    kept = latest_by_key(bronze, ["show_id"], newest_first(bronze))
    parsed = kept.withColumn("parsed_date", text.parse_date(F.col("date_added")))
    bad = text.unparsed(F.col("date_added"), F.col("parsed_date"))
    nulls = sum((F.count_if(F.col(c).isNull()) for c in TEXT_COLUMNS), F.lit(0))
    received = keyed.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).scalar()
    return parsed.agg(
        received.alias("records_received"),
        (received - F.count("*")).alias("duplicates_removed"),
        nulls.cast("long").alias("nulls_handled"),
        F.count_if(bad).alias("failed_dates_count"),
        F.count_if(~bad).alias("records_written"),
    )
