"""A star kept up by the titles of a delta (G1-G5 for I4).

What a set of titles contributes to the star is a function of their current versions and bridge rows. So a delta is applied
by taking away what its titles contributed before and adding what they contribute now: facts by replacing those of
the titles, dimension members by a count of the rows that use them (a member goes with its last row), KPI tables by sums
and counts per member. The work follows the delta and the buckets it touches; the result equals a star built anew.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions import calendar
from terrace.functions.keys import surrogate_key
from terrace.functions.ratios import round_to
from terrace.operators.scd import current_view
from terrace.operators.tables import add_default_member, by_rows
from terrace.plans import star as star_layer
from terrace.sources.sinks import run_together, stage
from terrace.sources.snapshots import Change, Lake, slices

TITLES = "silver_titles_scd2"
BY_SHOW, BY_TITLE = "xxhash64(show_id)", "title_key"  # the same hash, so a title has one bucket number everywhere

# dimension -> where its members are counted and the attribute
MEMBERS = {
    "dim_director": ("silver_directors", "director"),
    "dim_country": ("silver_country", "country"),
    "dim_genre": ("silver_genres", "genre"),
    "dim_rating": (TITLES, "rating"),
    "dim_type": (TITLES, "type"),
    "dim_date": (TITLES, "date_added"),
}
LARGE = ["dim_director"]  # dimensions that grow with the titles are dealt over as many buckets
USED = "used_by"
SUMS = ["facts", "movies", "tv_shows", "minutes", "with_minutes", "seasons", "with_seasons"]
# KPI table -> fact column it is grouped by
GROUPED = {
    "kpi_content_summary": None,
    "kpi_country_summary": "country_key",
    "kpi_genre_summary": "genre_key",
    "kpi_release_summary": "release_year",
    "kpi_rating_summary": "rating_key",
}
KPI_PARTS = "kpi_parts"


def member_counts(titles: DataFrame, bridges: Mapping[str, DataFrame], dim: str) -> DataFrame:
    """Key, value and number of rows using it, of every member of a dimension among some titles."""
    source, attribute = MEMBERS[dim]
    rows = titles if source == TITLES else bridges[source]
    if dim == "dim_date":
        rows = rows.filter(F.col(attribute).isNotNull())
    key = calendar.date_key(F.col(attribute)) if dim == "dim_date" else surrogate_key(attribute)
    name = "date_key" if dim == "dim_date" else f"{attribute}_key"
    return rows.groupBy(attribute).agg(F.count("*").alias(USED)).select(key.alias(name), attribute, USED)


def kpi_parts(fact: DataFrame) -> DataFrame:
    """Sums and counts of the facts per KPI table and member; they add up and can be taken away again."""
    kind = F.col("type_key")
    sums = [
        F.count("title_key").alias("facts"),
        F.count_if(kind == surrogate_key(F.lit("Movie"))).alias("movies"),
        F.count_if(kind == surrogate_key(F.lit("TV Show"))).alias("tv_shows"),
        F.coalesce(F.sum("duration_minutes"), F.lit(0)).alias("minutes"),
        F.count("duration_minutes").alias("with_minutes"),
        F.coalesce(F.sum("season_count"), F.lit(0)).alias("seasons"),
        F.count("season_count").alias("with_seasons"),
    ]
    # One pass over the facts down to the finest combination, from which every table is summed.
    fine = [c for c in GROUPED.values() if c]
    finest = fact.groupBy(*fine).agg(*sums)
    tables = F.array(*(F.struct(F.lit(t).alias("kpi"), (F.col(c) if c else F.lit(None)).cast("long").alias("member")) for t, c in GROUPED.items()))
    return finest.select(F.explode(tables).alias("at"), *SUMS).groupBy("at.kpi", "at.member").agg(*(F.sum(c).alias(c) for c in SUMS))


def difference(plus: DataFrame, minus: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """What to add to stored counts: new contributions less old ones, without the rows that stay as they are."""
    signed = plus.select(*by, *sums).unionByName(minus.select(*by, *((-F.col(c)).alias(c) for c in sums)))
    net = signed.groupBy(*by).agg(*(F.sum(c).alias(c) for c in sums))
    return net.filter(reduce(lambda a, b: a | b, (F.col(c) != 0 for c in sums)))


def added(stored: DataFrame, net: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Stored counts and a difference; rows whose first count falls to zero go."""
    both = stored.select(*by, *sums).unionByName(net.select(*by, *sums))
    return both.groupBy(*by).agg(*(F.sum(c).alias(c) for c in sums)).filter(F.col(sums[0]) > 0)


def kpi_tables(parts: DataFrame, dims: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """G5 from the stored sums: the same tables as :func:`terrace.plans.star.kpi_tables` makes from the facts."""

    def of(kpi: str) -> DataFrame:
        return parts.filter(F.col("kpi") == kpi)

    def per_member(kpi: str, dim: str, attribute: str) -> DataFrame:
        named = of(kpi).join(by_rows(dims[dim]), F.col("member") == F.col(f"{attribute}_key"))
        return named.select(attribute, F.col("facts").alias("total_content")).orderBy(F.desc("total_content"), attribute)

    def total(c: str):
        return F.coalesce(F.sum(c), F.lit(0))

    mean = lambda c, n: round_to(F.try_divide(F.sum(c).cast("double"), F.sum(n).cast("double")), 2)
    return {
        "kpi_content_summary": of("kpi_content_summary").agg(
            total("facts").alias("total_records"), total("movies").alias("total_movies"), total("tv_shows").alias("total_tv_shows"),
            mean("minutes", "with_minutes").alias("avg_movie_duration_mins"), mean("seasons", "with_seasons").alias("avg_tv_seasons"),
        ),
        "kpi_country_summary": per_member("kpi_country_summary", "dim_country", "country"),
        "kpi_genre_summary": per_member("kpi_genre_summary", "dim_genre", "genre"),
        "kpi_release_summary": of("kpi_release_summary").select(F.col("member").cast("int").alias("release_year"), F.col("facts").alias("yearly_releases")).orderBy("release_year"),
        "kpi_rating_summary": per_member("kpi_rating_summary", "dim_rating", "rating"),
    }


def _key(dim: str) -> str:
    return "date_key" if dim == "dim_date" else f"{MEMBERS[dim][1]}_key"


def _facts(titles: DataFrame, bridges: Mapping[str, DataFrame], batch_id: str, run_id: str) -> DataFrame:
    return star_layer.build_fact(titles, bridges["silver_country"], bridges["silver_genres"], bridges["silver_directors"], batch_id, run_id)


def _write_kpis(change: Change) -> None:
    parts, dims = change.read(KPI_PARTS), {d: change.read(d) for d in ("dim_country", "dim_genre", "dim_rating")}
    run_together(partial(change.replace, name, table, "0L") for name, table in kpi_tables(parts, dims).items())


def rebuild(change: Change, titles: DataFrame, bridges: Mapping[str, DataFrame], batch_id: str, run_id: str, buckets: int) -> None:
    """G1-G5 from all current titles and their bridge rows (those stored), as new versions of every gold table."""

    def fact() -> None:
        first, *others = slices(range(buckets))
        if not others:
            return change.replace("fact_content", _facts(titles, bridges, batch_id, run_id), BY_TITLE, buckets)
        of = lambda some: _facts(current_view(change.read(TITLES, some)), {b: change.read(b, some) for b in bridges}, batch_id, run_id)
        change.replace("fact_content", of(first), BY_TITLE, buckets)
        for some in others:
            change.rewrite("fact_content", of(some), some)

    jobs = [
        fact,
        partial(change.replace, "dim_title", star_layer.build_dim_title(titles), BY_TITLE, buckets),
        *(partial(change.replace, d, member_counts(titles, bridges, d), _key(d), buckets if d in LARGE else 1) for d in MEMBERS),
    ]
    run_together(jobs)
    change.replace(KPI_PARTS, kpi_parts(change.read("fact_content")), "0L")
    _write_kpis(change)


def refresh(
    change: Change, keys: DataFrame, old: tuple[DataFrame, Mapping[str, DataFrame]], new: tuple[DataFrame, Mapping[str, DataFrame]],
    batch_id: str, run_id: str,
) -> None:
    """G1-G5 after the titles ``keys`` (show_id) changed: ``old`` and ``new`` are their current rows and bridge rows."""
    title_keys = by_rows(keys.select(surrogate_key("show_id").alias("title_key")))
    facts = stage(_facts(*new, batch_id, run_id), "facts")
    touched = change.touched("fact_content", title_keys)

    def rewritten(name: str, rows: DataFrame) -> None:
        def of(some: Sequence[int]) -> DataFrame:
            kept = change.read(name, some).join(change.within(name, title_keys, some), "title_key", "left_anti")
            return kept.unionByName(change.within(name, rows, some))

        change.rewrite_sliced(name, of, touched)

    def member(dim: str) -> None:
        by = [_key(dim), MEMBERS[dim][1]]
        net = stage(difference(member_counts(*new, dim), member_counts(*old, dim), by, [USED]), dim)
        buckets = change.touched(dim, net)
        if buckets:
            change.rewrite(dim, added(change.read(dim, buckets), net, by, [USED]), buckets)

    def kpis() -> None:
        by = ["kpi", "member"]
        net = stage(difference(kpi_parts(facts), kpi_parts(_facts(*old, batch_id, run_id)), by, SUMS), "kpis")
        change.replace(KPI_PARTS, added(change.read(KPI_PARTS), net, by, SUMS), "0L")

    run_together(
        [
            partial(rewritten, "fact_content", facts),
            partial(rewritten, "dim_title", star_layer.build_dim_title(new[0])),
            *(partial(member, d) for d in MEMBERS),
            kpis,
        ]
    )
    _write_kpis(change)


def read_star(lake: Lake, version: int | None = None) -> star_layer.Star:
    """The stored star as of one version: dimensions without their use counts, the calendar with its unknown member."""
    snapshot = lake.snapshot(version)

    def dim(name: str) -> DataFrame:
        rows = lake.frame(snapshot.tables[name]).drop(USED)
        if name != "dim_date":
            return rows
        days = rows.select("date_key", "date_added", *(c.alias(n) for n, c in calendar.calendar_columns(F.col("date_added")).items()))
        return add_default_member(days, {"date_key": calendar.UNKNOWN_DATE_KEY})

    return star_layer.Star(lake.frame(snapshot.tables["fact_content"]), {n: dim(n) for n in star_layer.DIMENSIONS})
