from datetime import date

import pytest
from pyspark.sql import functions as F

from terrace.functions import calendar, labels, ratios, text
from terrace.plans import silver

from fixtures import raw_frame




@pytest.fixture
def built(spark):
    # Leading blanks sort first, so the untidy copy of m7 is the one kept.
    return silver.build_silver(raw_frame(spark), 2026, order=[F.col("title").asc()])


def test_titles(built):
    got = {r.show_id: r for r in built.titles.collect()}
    assert set(got) == {"m7", "m9", "t2"}
    movie, series, undated = got["m7"], got["t2"], got["m9"]
    assert (movie.type, movie.title, movie.date_added) == ("Movie", "Harbour Lights", date(2018, 3, 3))
    assert (movie.duration_minutes, movie.season_count, movie.rating) == (104, None, "UR")
    assert (movie.is_recent_release, movie.content_age) == (False, 9)
    assert (series.type, series.season_count, series.duration_minutes) == ("TV Show", 3, None)
    assert (series.is_recent_release, series.content_age) == (True, 1)
    assert (undated.rating, undated.date_added, undated.duration_minutes) == ("PG", None, 81)


def test_titles_schema(built):
    assert built.titles.columns == silver.TITLE_COLUMNS
    types = dict(built.titles.dtypes)
    assert (types["date_added"], types["release_year"], types["is_recent_release"]) == ("date", "int", "boolean")


def test_bridges(built):
    pairs = {n: sorted(tuple(r) for r in df.collect()) for n, df in built.bridges.items()}
    assert pairs["silver_country"] == [("m7", "New Zealand"), ("m9", "Unknown Country"), ("t2", "Kenya"), ("t2", "Peru")]
    assert [v for k, v in pairs["silver_cast"] if k == "m7"] == ["Ada Lind", "Tom Okoro"]
    assert [v for k, v in pairs["silver_genres"] if k == "m7"] == ["Sea Stories", "Thrillers"]
    assert [v for k, v in pairs["silver_directors"] if k == "m9"] == ["Ito Mai", "Ravi Sen"]
    assert [v for k, v in pairs["silver_directors"] if k == "t2"] == ["Unknown Director"]


def test_date_rejects(built):
    assert [(r.show_id, r.reason_for_failure) for r in built.rejects.collect()] == [("x4", "Unparseable date_added format")]


def test_metrics_in_one_row(spark):
    row = silver.silver_metrics(raw_frame(spark)).first()
    assert (row.records_received, row.duplicates_removed, row.failed_dates_count, row.records_written) == (5, 1, 1, 3)


def test_column_functions(spark):
    df = spark.createDataFrame([("1998", "90 min", 1.005, 135)], "y string, d string, r double, m int")
    row = df.select(
        calendar.decade_label(F.col("y").cast("int")).alias("decade"),
        text.leading_int(F.col("d")).alias("lead"),
        text.safe_int(F.lit("x")).alias("bad"),
        ratios.round_to(F.col("r"), 2).alias("r"),
        ratios.ratio_pct(F.lit(2), F.lit(3)).alias("pct"),
        ratios.ratio_pct(F.lit(2), F.lit(0)).alias("nothing"),
        *(c.alias(n) for c, n in zip(ratios.split_minutes(F.col("m")), ("h", "mm"))),
        text.canonicalize(F.lit(" tv SHOW"), silver.TYPES).alias("known"),
        text.canonicalize(F.lit("short FILM"), silver.TYPES).alias("other"),
        labels.bands(F.lit(None).cast("int"), labels.below(F.lit(None).cast("int"), (1, "a")), "z").alias("band"),
        calendar.date_key(F.lit(None).cast("date")).alias("dk"),
    ).first()
    assert tuple(row) == ("1990s", 90, None, 1.01, 66.67, None, 2, 15, "TV Show", "Short Film", "z", -1)
