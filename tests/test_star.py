from datetime import date

import pytest

from terrace.operators import scd
from terrace.plans import business, star, views

from fixtures import NOW, bridge, titles_frame


@pytest.fixture
def gold(spark, tmp_path):
    titles = titles_frame(
        spark,
        [
            {"show_id": "s1", "type": "Movie", "title": "A", "date_added": date(2021, 9, 25), "release_year": 2020, "rating": "PG-13", "duration_minutes": 90, "content_age": 6},
            {"show_id": "s2", "type": "TV Show", "title": "B", "date_added": date(2021, 9, 24), "release_year": 2021, "rating": "TV-MA", "season_count": 2, "content_age": 5},
            {"show_id": "s3", "type": "Movie", "title": "C", "release_year": 2019, "rating": "R", "duration_minutes": 120, "content_age": 7},
        ],
    )
    bridges = {
        "silver_country": bridge(spark, "country", [("s1", "United States"), ("s2", "South Africa"), ("s3", "United States")]),
        "silver_genres": bridge(spark, "genre", [("s1", "Documentaries"), ("s2", "Dramas"), ("s3", "Comedies")]),
        "silver_directors": bridge(spark, "director", [("s1", "Director A"), ("s2", "Director B"), ("s3", "Director A")]),
    }
    built = star.build_star(titles, bridges, "b1", "r1")
    return titles, bridges, star.write_star(built, str(tmp_path / "gold")), tmp_path / "gold"


def test_dimensions_and_fact(gold):
    titles, _, g, folder = gold
    counts = {n: d.count() for n, d in g.dims.items()}
    assert (counts["dim_title"], counts["dim_director"], counts["dim_country"]) == (3, 2, 2)
    unknown = g.dims["dim_date"].filter("date_key = -1").collect()
    assert len(unknown) == 1 and unknown[0].date_added is None
    keyed = g.fact.join(g.dims["dim_title"].select("title_key", "show_id"), "title_key").collect()
    by_id = {r.show_id: r for r in keyed}
    assert len(keyed) == 3
    assert (by_id["s1"].date_key, by_id["s1"].duration_minutes, by_id["s1"].season_count) == (20210925, 90, None)
    assert by_id["s3"].date_key == -1
    assert (folder / "fact_content/release_year=2020").is_dir()


def test_content_kpi(spark, gold):
    kpi = spark.read.parquet(str(gold[3] / "kpi_content_summary")).first()
    assert tuple(kpi) == (3, 2, 1, 105.0, 2.0)


def test_integrity(gold):
    titles, bridges, g, _ = gold
    assert {r.violations for r in star.integrity_report(g, bridges, titles).collect()} == {0}


def test_unknown_date_exists_without_any_date(spark, gold):
    assert [r.date_key for r in star.build_dim_date(gold[0].filter("show_id = 's3'")).collect()] == [-1]


def test_only_current_versions_reach_the_star(spark, gold):
    titles, bridges, _, _ = gold
    history = scd.scd2_initial(titles, ["show_id"], date(2026, 1, 1), NOW)
    changed = titles.filter("show_id = 's1'").replace("A", "A2", subset=["title"])
    history = scd.scd2_merge(history, changed, ["show_id"], ["title"], date(2026, 2, 1), NOW)
    assert star.build_star(history, bridges, "b", "r").fact.count() == 3
    assert star.build_star(history, bridges, "b", "r", current_only=False).fact.count() == 4


def test_views(gold):
    _, _, g, _ = gold
    assert tuple(views.general_summary(g).first()) == (3, 2, 1, 6.0)
    shares = {r.country_name: (r.titles_count, r.percentage_share) for r in views.country_distribution(g).collect()}
    assert shares == {"United States": (2, 66.67), "South Africa": (1, 33.33)}
    assert tuple(views.filtered_summary(g, {"country": "South Africa"}).first()) == (1, 0, 1, 5.0)
    assert tuple(views.filtered_summary(g, {"country": "O'Hare"}).first()) == (0, 0, 0, None)
    assert views.country_profile(g, min_titles=2).count() == 1


@pytest.fixture
def shelf(spark):
    titles = titles_frame(
        spark,
        [
            {"show_id": "s1", "type": "Movie", "release_year": 2020, "duration_minutes": 90, "rating": "PG"},
            {"show_id": "s2", "type": "TV Show", "release_year": 2021, "season_count": 2, "rating": "R"},
            {"show_id": "s3", "type": "Movie", "release_year": 2019, "duration_minutes": 120, "rating": "PG"},
            {"show_id": "s4", "type": "Movie", "release_year": 1998, "duration_minutes": 110, "rating": "PG"},
        ],
    )
    bridges = {
        "silver_country": bridge(spark, "country", [("s1", "US"), ("s2", "South Africa"), ("s2", "US"), ("s3", "US"), ("s4", "India")]),
        "silver_genres": bridge(spark, "genre", [("s1", "Documentaries"), ("s2", "Dramas"), ("s2", "Mysteries"), ("s3", "Comedies"), ("s4", "Action")]),
        "silver_directors": bridge(spark, "director", [("s1", "A"), ("s2", "B"), ("s3", "A"), ("s4", "C")]),
    }
    return titles, bridges


def test_business_transforms(spark, shelf, tmp_path):
    business.run_business_transforms(*shelf, str(tmp_path))
    out = {p.name: spark.read.parquet(str(p)) for p in tmp_path.iterdir()}
    assert tuple(out["kpi_summary"].first()) == (4, 3, 1, 106.67, 2.0, 75.0, 25.0)
    us = out["country_distribution"].filter("country = 'US'").first()
    assert (us.total_content, us.total_movies, us.total_tv_shows) == (3, 2, 1)
    top = out["director_rankings"].filter("director_rank = 1").first()
    assert (top.director, top.title_count) == ("A", 2)
    assert sorted(r.director_rank for r in out["director_rankings"].collect()) == [1, 2, 3]
    years = {r.release_year: r for r in out["yearly_releases_summary"].collect()}
    assert (years[1998].yearly_releases, years[1998].running_total_releases, years[1998].yearly_growth_pct) == (1, 1, 0.0)
    assert years[2021].running_total_releases == 4
    s4 = out["gold_titles_enriched"].filter("show_id = 's4'").first()
    assert (s4.release_decade, s4.is_classic, s4.content_category, s4.duration_bucket) == ("1990s", True, "Classic", "Medium (60m-120m)")
    assert len(out) == 8
