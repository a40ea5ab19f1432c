"""KPI views, star and business queries over the catalog (K, G, W, A on the star)."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite import lake
from suite.lake import over_fact, over_silver, rounded
from suite.registry import query
from terrace.operators import ranking, rollups
from terrace.operators.tables import by_rows
from terrace.plans import business, star as star_layer, views


@query(
    over_fact(
        f"""
SELECT count(DISTINCT show_id) AS total_titles,
       count(DISTINCT CASE WHEN type = 'Movie' THEN show_id END) AS total_movies,
       count(DISTINCT CASE WHEN type = 'TV Show' THEN show_id END) AS total_tv_shows,
       (SELECT {rounded("avg(content_age)", 1)} FROM (SELECT DISTINCT show_id, content_age FROM fact)) AS average_content_age
FROM fact"""
    )
)
def general_summary(spark, sf):
    return views.general_summary(lake.star(spark, sf))


@query(
    over_fact(
        f"""
SELECT country AS country_name, count(DISTINCT show_id) AS titles_count,
       {rounded("100.0 * count(DISTINCT show_id)::DOUBLE / sum(count(DISTINCT show_id)) OVER ()::DOUBLE", 2)} AS percentage_share
FROM fact WHERE country <> 'Unknown Country' GROUP BY country"""
    )
)
def country_distribution_view(spark, sf):
    return views.country_distribution(lake.star(spark, sf))


@query(over_fact("SELECT genre AS genre_name, count(DISTINCT show_id) AS titles_count FROM fact WHERE genre <> 'Unknown' GROUP BY genre"))
def genre_distribution_view(spark, sf):
    return views.genre_distribution(lake.star(spark, sf))


@query(
    over_fact(
        "SELECT director AS director_name, count(DISTINCT show_id) AS titles_count FROM fact "
        "WHERE director <> 'Unknown Director' GROUP BY director"
    )
)
def director_distribution_view(spark, sf):
    return views.director_distribution(lake.star(spark, sf))


@query(over_fact("SELECT rating AS rating_name, count(DISTINCT show_id) AS titles_count FROM fact GROUP BY rating"))
def rating_distribution_view(spark, sf):
    return views.rating_distribution(lake.star(spark, sf))


@query(over_fact("SELECT release_year, type AS type_name, count(DISTINCT show_id) AS releases_count FROM fact GROUP BY release_year, type"))
def release_trends_view(spark, sf):
    return views.release_trends(lake.star(spark, sf))


@query(
    over_fact(
        f"""
SELECT count(DISTINCT show_id) AS total_titles,
       count(DISTINCT CASE WHEN type = 'Movie' THEN show_id END) AS total_movies,
       count(DISTINCT CASE WHEN type = 'TV Show' THEN show_id END) AS total_tv_shows,
       {rounded("avg(content_age)", 1)} AS average_content_age
FROM fact WHERE country = 'Nation_7' AND release_year BETWEEN 1996 AND 1999"""
    )
)
def filtered_summary(spark, sf):
    return views.filtered_summary(lake.star(spark, sf), {"country": "Nation_7", "start_year": 1996, "end_year": 1999})


@query(
    over_fact(
        """
SELECT genre AS genre_name, count(DISTINCT show_id) AS titles_count FROM fact
WHERE genre <> 'Unknown' AND country = 'Nation_7' AND type = 'Movie' AND release_year = 1998
GROUP BY genre ORDER BY titles_count DESC, genre_name LIMIT 5"""
    )
)
def filtered_genres(spark, sf):
    return views.filtered_genres(lake.star(spark, sf), {"country": "Nation_7", "type": "Movie", "year": 1998}, 5)


@query(
    over_fact(
        """
SELECT release_year, count(DISTINCT show_id) AS total_releases,
       count(DISTINCT CASE WHEN type = 'Movie' THEN show_id END) AS movie_releases,
       count(DISTINCT CASE WHEN type = 'TV Show' THEN show_id END) AS tv_releases
FROM fact WHERE release_year BETWEEN 1995 AND 2021 GROUP BY release_year"""
    )
)
def yearly_trend(spark, sf):
    return views.yearly_trend(lake.star(spark, sf), 1995, 2021)


@query(
    over_fact(
        """
SELECT release_year, count(DISTINCT show_id) AS total_releases,
       count(DISTINCT CASE WHEN type = 'Movie' THEN show_id END) AS movie_releases,
       count(DISTINCT CASE WHEN type = 'TV Show' THEN show_id END) AS tv_releases
FROM fact WHERE release_year IS NOT NULL GROUP BY release_year"""
    )
)
def yearly_trend_of_all_years(spark, sf):
    return views.yearly_trend(lake.star(spark, sf)).where("release_year IS NOT NULL")


COUNTRY_PROFILE = f"""
SELECT country AS country_name, count(DISTINCT show_id) AS titles_count,
       count(DISTINCT CASE WHEN type = 'Movie' THEN show_id END) AS movie_count,
       count(DISTINCT CASE WHEN type = 'TV Show' THEN show_id END) AS tv_count,
       {rounded("avg(duration_minutes)", 1)} AS avg_movie_duration,
       {rounded("avg(content_age)", 1)} AS avg_content_age
FROM fact WHERE country <> 'Unknown Country'
GROUP BY country HAVING count(DISTINCT show_id) >= 10"""


@query(over_fact(COUNTRY_PROFILE))
def country_profile(spark, sf):
    return views.country_profile(lake.star(spark, sf))


@query(
    over_fact(
        f"""
SELECT *, {rounded("100.0 * total_movies::DOUBLE / total_titles::DOUBLE", 2)} AS movie_ratio_pct,
       {rounded("100.0 * total_tv_shows::DOUBLE / total_titles::DOUBLE", 2)} AS tv_ratio_pct,
       (SELECT country FROM fact WHERE country <> 'Unknown Country' GROUP BY country ORDER BY count(DISTINCT show_id) DESC, country LIMIT 1) AS top_country,
       (SELECT genre FROM fact WHERE genre <> 'Unknown' GROUP BY genre ORDER BY count(DISTINCT show_id) DESC, genre LIMIT 1) AS top_genre,
       (SELECT director FROM fact WHERE director <> 'Unknown Director' GROUP BY director ORDER BY count(DISTINCT show_id) DESC, director LIMIT 1) AS top_director
FROM (
  SELECT count(DISTINCT show_id) AS total_titles,
         count(DISTINCT CASE WHEN type = 'Movie' THEN show_id END) AS total_movies,
         count(DISTINCT CASE WHEN type = 'TV Show' THEN show_id END) AS total_tv_shows,
         {rounded("avg(content_age)", 1)} AS average_content_age
  FROM silver_titles)"""
    )
)
def executive_row(spark, sf):
    return views.executive_row(lake.titles(spark, sf), lake.star(spark, sf))


@query(
    over_fact(
        """
SELECT title, type, country, genre, release_year, duration_minutes FROM fact
ORDER BY release_year DESC NULLS LAST, title, country, genre LIMIT 15"""
    )
)
def newest_titles(spark, sf):
    return views.detail_listing(lake.star(spark, sf))


# --- star ---------------------------------------------------------------------------------------


@query(
    over_silver(
        """
SELECT DISTINCT show_id, title, description, release_year < 2000 AS is_classic,
       CASE WHEN release_year < 2000 THEN 'Classic' ELSE 'Modern' END AS content_category
FROM silver_titles"""
    )
)
def dim_title(spark, sf):
    return lake.star(spark, sf).dims["dim_title"].drop("title_key")


@query(
    over_silver(
        """
SELECT 'country' AS dimension, country AS member FROM silver_country
UNION SELECT 'genre', genre FROM silver_genres
UNION SELECT 'director', director FROM silver_directors
UNION SELECT 'rating', rating FROM silver_titles
UNION SELECT 'type', type FROM silver_titles"""
    )
)
def dimension_members(spark, sf):
    from terrace.operators.tables import labelled_union

    dims = lake.star(spark, sf).dims
    names = ("country", "genre", "director", "rating", "type")
    return labelled_union({n: dims[f"dim_{n}"].select(F.col(n).alias("member")) for n in names}, "dimension")


@query(
    over_silver(
        """
SELECT CAST(strftime(date_added, '%Y%m%d') AS INTEGER) AS date_key, date_added,
       CAST(year(date_added) AS INTEGER) AS year, CAST(month(date_added) AS INTEGER) AS month,
       CAST(day(date_added) AS INTEGER) AS day, CAST(quarter(date_added) AS INTEGER) AS quarter,
       CAST(dayofweek(date_added) + 1 AS INTEGER) AS day_of_week
FROM (SELECT DISTINCT date_added FROM silver_titles WHERE date_added IS NOT NULL)
UNION ALL SELECT -1, NULL, NULL, NULL, NULL, NULL, NULL"""
    )
)
def dim_date(spark, sf):
    return lake.star(spark, sf).dims["dim_date"]


@query(
    over_fact(
        """
SELECT show_id, country, genre, director, rating, type, date_added, release_year,
       coalesce(CAST(strftime(date_added, '%Y%m%d') AS INTEGER), -1) AS date_key, duration_minutes, season_count, content_age
FROM fact"""
    )
)
def fact_content(spark, sf):
    star = lake.star(spark, sf)
    # Titles first, while the facts that are shuffled for it hold keys only and a title's facts lie together.
    titled = star.fact.join(by_rows(star.dims["dim_title"].select("title_key", "show_id")), "title_key")
    named = views.with_attributes(star_layer.Star(titled, star.dims), "country", "genre", "director", "rating", "type")
    return named.join(by_rows(star.dims["dim_date"].select("date_key", "date_added")), "date_key").select(
        "show_id", "country", "genre", "director", "rating", "type", "date_added", "release_year",
        "date_key", "duration_minutes", "season_count", "content_age",
    )


@query(
    over_fact(
        f"""
SELECT count(*) AS total_records, count(*) FILTER (type = 'Movie') AS total_movies,
       count(*) FILTER (type = 'TV Show') AS total_tv_shows,
       {rounded("avg(duration_minutes)", 2)} AS avg_movie_duration_mins,
       {rounded("avg(season_count)", 2)} AS avg_tv_seasons
FROM fact"""
    )
)
def kpi_content_summary(spark, sf):
    return star_layer.kpi_tables(lake.star(spark, sf))["kpi_content_summary"]


@query(over_fact("SELECT country, count(*) AS total_content FROM fact GROUP BY country"))
def kpi_country_summary(spark, sf):
    return star_layer.kpi_tables(lake.star(spark, sf))["kpi_country_summary"]


@query(over_fact("SELECT genre, count(*) AS total_content FROM fact GROUP BY genre"))
def kpi_genre_summary(spark, sf):
    return star_layer.kpi_tables(lake.star(spark, sf))["kpi_genre_summary"]


@query(over_fact("SELECT release_year, count(*) AS yearly_releases FROM fact GROUP BY release_year"))
def kpi_release_summary(spark, sf):
    return star_layer.kpi_tables(lake.star(spark, sf))["kpi_release_summary"]


@query(over_fact("SELECT rating, count(*) AS total_content FROM fact GROUP BY rating"))
def kpi_rating_summary(spark, sf):
    return star_layer.kpi_tables(lake.star(spark, sf))["kpi_rating_summary"]


@query(
    over_fact(
        """
SELECT 'fk_fact_' || d AS constraint_name, 0::BIGINT AS violations
FROM (SELECT unnest(['title','director','country','genre','rating','type','date']) AS d)
UNION ALL SELECT 'pk_dim_' || d, 0 FROM (SELECT unnest(['title','director','country','genre','rating','type','date']) AS d)
UNION ALL SELECT 'fk_silver_country', count(*) FROM silver_country WHERE show_id NOT IN (SELECT show_id FROM silver_titles)
UNION ALL SELECT 'fk_silver_genres', count(*) FROM silver_genres WHERE show_id NOT IN (SELECT show_id FROM silver_titles)
UNION ALL SELECT 'fk_silver_directors', count(*) FROM silver_directors WHERE show_id NOT IN (SELECT show_id FROM silver_titles)
UNION ALL SELECT 'fk_silver_cast', count(*) FROM silver_cast WHERE show_id NOT IN (SELECT show_id FROM silver_titles)
UNION ALL SELECT 'pk_silver_country', count(*) FROM (SELECT 1 FROM silver_country GROUP BY show_id, country HAVING count(*) > 1)
UNION ALL SELECT 'pk_silver_genres', count(*) FROM (SELECT 1 FROM silver_genres GROUP BY show_id, genre HAVING count(*) > 1)
UNION ALL SELECT 'pk_silver_directors', count(*) FROM (SELECT 1 FROM silver_directors GROUP BY show_id, director HAVING count(*) > 1)
UNION ALL SELECT 'pk_silver_cast', count(*) FROM (SELECT 1 FROM silver_cast GROUP BY show_id, cast_member HAVING count(*) > 1)"""
    )
)
def integrity_report(spark, sf):
    return star_layer.integrity_report(lake.star(spark, sf), lake.bridges(spark, sf), lake.titles(spark, sf))


# --- business transforms over silver ------------------------------------------------------------


@query(
    over_silver(
        f"""
SELECT count(*) AS total_content, count(*) FILTER (type = 'Movie') AS total_movies,
       count(*) FILTER (type = 'TV Show') AS total_tv_shows,
       {rounded("avg(duration_minutes)", 2)} AS avg_movie_duration_mins,
       {rounded("avg(season_count)", 2)} AS avg_tv_seasons,
       {rounded("100.0 * (count(*) FILTER (type = 'Movie'))::DOUBLE / count(*)::DOUBLE", 2)} AS movies_ratio_pct,
       {rounded("100.0 * (count(*) FILTER (type = 'TV Show'))::DOUBLE / count(*)::DOUBLE", 2)} AS tv_shows_ratio_pct
FROM silver_titles"""
    )
)
def kpi_summary(spark, sf):
    return business.kpi_summary(lake.titles(spark, sf))


BY_TYPE = (
    "count(*) AS total_content, count(*) FILTER (type = 'Movie') AS total_movies, "
    "count(*) FILTER (type = 'TV Show') AS total_tv_shows"
)


@query(over_silver(f"SELECT country, {BY_TYPE} FROM silver_titles JOIN silver_country USING (show_id) GROUP BY country"))
def country_distribution(spark, sf):
    return business.distribution(lake.titles(spark, sf), lake.bridges(spark, sf)["silver_country"], "country")


@query(over_silver(f"SELECT genre, {BY_TYPE} FROM silver_titles JOIN silver_genres USING (show_id) GROUP BY genre"))
def genre_distribution(spark, sf):
    return business.distribution(lake.titles(spark, sf), lake.bridges(spark, sf)["silver_genres"], "genre")


@query(over_silver("SELECT rating, count(*) AS total_content FROM silver_titles GROUP BY rating"))
def rating_distribution(spark, sf):
    return business.rating_distribution(lake.titles(spark, sf))


@query(
    over_silver(
        """
SELECT * FROM (
  SELECT country, genre, count(*) AS genre_count,
         CAST(dense_rank() OVER (PARTITION BY country ORDER BY count(*) DESC) AS INTEGER) AS genre_rank
  FROM silver_country JOIN silver_genres USING (show_id) GROUP BY country, genre)
WHERE genre_rank <= 3"""
    )
)
def top_genres_by_country(spark, sf):
    b = lake.bridges(spark, sf)
    return business.top_genres_by_country(lake.titles(spark, sf), b["silver_country"], b["silver_genres"])


@query(
    over_silver(
        """
SELECT director, title_count, row_number() OVER (ORDER BY title_count DESC, director) AS director_rank
FROM (SELECT director, count(*) AS title_count FROM silver_directors WHERE director <> 'Unknown Director' GROUP BY director)"""
    )
)
def director_rankings(spark, sf):
    return business.director_rankings(lake.titles(spark, sf), lake.bridges(spark, sf)["silver_directors"])


@query(
    over_silver(
        f"""
SELECT release_year, yearly_releases, CAST(sum(yearly_releases) OVER w AS BIGINT) AS running_total_releases,
       {rounded("(yearly_releases - coalesce(lag(yearly_releases) OVER w, yearly_releases))::DOUBLE * 100.0 / coalesce(lag(yearly_releases) OVER w, yearly_releases)::DOUBLE", 2)} AS yearly_growth_pct
FROM (SELECT release_year, count(*) AS yearly_releases FROM silver_titles GROUP BY release_year)
WINDOW w AS (ORDER BY release_year)"""
    )
)
def yearly_releases(spark, sf):
    return business.yearly_releases(lake.titles(spark, sf))


@query(
    over_silver(
        """
SELECT show_id, type, title, release_year,
       CAST(CAST(floor(release_year / 10.0) * 10 AS INTEGER) AS VARCHAR) || 's' AS release_decade,
       release_year < 2000 AS is_classic,
       CASE WHEN release_year < 2000 THEN 'Classic' ELSE 'Modern' END AS content_category,
       CASE WHEN type = 'Movie' THEN
              CASE WHEN duration_minutes < 60 THEN 'Short (<60m)' WHEN duration_minutes < 120 THEN 'Medium (60m-120m)' ELSE 'Long (>120m)' END
            ELSE CASE WHEN season_count = 1 THEN 'Single Season' WHEN season_count <= 3 THEN 'Mid-Length Series' ELSE 'Long Running Series' END
       END AS duration_bucket
FROM silver_titles"""
    )
)
def titles_enriched(spark, sf):
    return business.enrich_titles(lake.titles(spark, sf)).select(
        "show_id", "type", "title", "release_year", "release_decade", "is_classic", "content_category", "duration_bucket"
    )


@query(
    over_silver(
        f"""
SELECT genre, titles_count,
       {rounded("100.0 * titles_count::DOUBLE / sum(titles_count) OVER ()::DOUBLE", 2)} AS assignment_share,
       {rounded("100.0 * titles_count::DOUBLE / (SELECT count(DISTINCT show_id) FROM silver_titles)::DOUBLE", 2)} AS catalog_share
FROM (SELECT genre, count(DISTINCT show_id) AS titles_count FROM silver_genres GROUP BY genre)"""
    )
)
def genre_shares(spark, sf):
    counted = rollups.entity_rollup(lake.bridges(spark, sf)["silver_genres"], ["genre"], "show_id")
    return rollups.shares(counted, "titles_count", lake.titles(spark, sf), "show_id")


@query(
    over_fact(
        "SELECT release_year, count(DISTINCT show_id) AS titles_count FROM fact GROUP BY release_year "
        "ORDER BY titles_count DESC, release_year LIMIT 1"
    )
)
def peak_release_year(spark, sf):
    counted = rollups.entity_rollup(lake.star(spark, sf).fact, ["release_year"], "title_key")
    return ranking.top_n(counted, [F.desc("titles_count"), F.asc("release_year")], 1)
