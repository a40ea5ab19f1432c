"""Small inputs shared by the tests."""

from datetime import datetime

from pyspark.sql import functions as F

from terrace.plans.silver import RAW_COLUMNS

NOW = datetime(2026, 7, 20, 9, 0)

RAW = [
    ("m7", "MOVIE ", " Harbour   Lights", "Ilse Varga", "Tom Okoro,  Ada Lind", " new   zealand ", "March 3, 2018", "2017", None, "104 min", "Thrillers, Sea Stories", "d"),
    ("m7", "movie", "Harbour Lights, again", "Ilse Varga", "Tom Okoro", "new zealand", "March 3, 2018", "2017", None, "104 min", "Thrillers", "d"),
    ("t2", "tv show", "Salt Road", None, None, "Kenya, Peru", "January 15, 2025", "2025", "TV-14", "3 Seasons", "Travel", "d"),
    ("m9", "Movie", "Paper Moons", "Ravi Sen, Ito Mai", "Lea Brandt", None, None, "2001", "PG", "81 min", None, "d"),
    ("x4", "Movie", "The Undated", "Ana Ruiz", None, "Chile", "2019.11.30", "2019", "R", "77 min", "Drama", "d"),
]


def raw_frame(spark, data=RAW, ts=datetime(2026, 7, 14), batch="b1"):
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in RAW_COLUMNS))
    return df.withColumns(
        {
            "batch_id": F.lit(batch),
            "pipeline_run_id": F.lit("run-1"),
            "ingestion_timestamp": F.lit(ts).cast("timestamp"),
        }
    )


TITLES = "show_id string, type string, title string, date_added date, release_year int, rating string, duration string, description string, content_age int, duration_minutes int, season_count int, is_recent_release boolean, batch_id string, pipeline_run_id string, ingestion_timestamp timestamp"


def titles_frame(spark, data):
    """Titles from dicts; unset columns are NULL."""
    cols = [c.split()[0] for c in TITLES.split(", ")]
    return spark.createDataFrame([tuple(d.get(c) for c in cols) for d in data], TITLES)


def bridge(spark, value, pairs):
    return spark.createDataFrame(pairs, f"show_id string, {value} string")
