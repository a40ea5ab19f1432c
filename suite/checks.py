"""Data quality over the catalog and the documents (Q)."""

from __future__ import annotations

from suite import lake
from suite.lake import over_raw, table
from suite.registry import query
from terrace.operators import quality
from terrace.plans.silver import RAW_COLUMNS

RULES = {
    "required_columns": RAW_COLUMNS,
    "ignore_columns": ["batch_id", "pipeline_run_id", "ingestion_timestamp"],
    "null_checks": ["show_id", "title", "type", "release_year"],
    "unique_checks": ["show_id"],
    "type_checks": {"release_year": "string"},
    "integer_columns": ["release_year"],
    "date_columns": {"date_added": "MMMM d, yyyy"},
    "value_sets": {"type": ["MOVIE", "TV Show"], "rating": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]},
    "ranges": {"release_year": (1800, 2026)},
    "max_values": {"release_year": 2026},
    "not_blank": ["duration"],
    "min_lengths": {"title": 1},
    "completeness_checks": ["country", "listed_in", "description"],
}

JUDGED = """,
repeats AS (SELECT show_id, count(*) AS n FROM raw GROUP BY show_id),
judged AS (
  SELECT raw.*, [m for m in [
    CASE WHEN show_id IS NULL THEN 'Null value in required column ''show_id''' END,
    CASE WHEN title IS NULL THEN 'Null value in required column ''title''' END,
    CASE WHEN type IS NULL THEN 'Null value in required column ''type''' END,
    CASE WHEN release_year IS NULL THEN 'Null value in required column ''release_year''' END,
    CASE WHEN n > 1 THEN 'Duplicate show_id key value' END,
    CASE WHEN release_year IS NOT NULL AND TRY_CAST(release_year AS INTEGER) IS NULL THEN 'release_year datatype is not castable to integer' END,
    CASE WHEN date_added IS NOT NULL AND try_strptime(trim(date_added), '%B %-d, %Y') IS NULL THEN 'date_added has invalid date format' END,
    CASE WHEN type NOT IN ('MOVIE', 'TV Show') THEN 'Invalid type (not Movie or TV Show)' END,
    CASE WHEN rating NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED') THEN 'Invalid rating categorization' END,
    CASE WHEN TRY_CAST(release_year AS INTEGER) > 2026 THEN 'release_year cannot be in the future' END,
    CASE WHEN duration IS NULL OR trim(duration) = '' THEN 'duration cannot be empty' END,
    CASE WHEN length(trim(title)) < 1 THEN 'title length is 0' END,
    CASE WHEN country IS NULL OR trim(country) = '' THEN 'Required field ''country'' is blank or empty' END,
    CASE WHEN listed_in IS NULL OR trim(listed_in) = '' THEN 'Required field ''listed_in'' is blank or empty' END,
    CASE WHEN description IS NULL OR trim(description) = '' THEN 'Required field ''description'' is blank or empty' END
  ] if m IS NOT NULL] AS reasons
  FROM raw LEFT JOIN repeats USING (show_id)
)
"""

_CHECKS = [
    ("not_null", "show_id", "show_id IS NULL"),
    ("not_null", "title", "title IS NULL"),
    ("not_null", "type", "type IS NULL"),
    ("not_null", "release_year", "release_year IS NULL"),
    ("castable_to_int", "release_year", "release_year IS NOT NULL AND TRY_CAST(release_year AS INTEGER) IS NULL"),
    ("date_format", "date_added", "date_added IS NOT NULL AND try_strptime(trim(date_added), '%B %-d, %Y') IS NULL"),
    ("in_set", "type", "type NOT IN ('MOVIE', 'TV Show')"),
    ("in_set", "rating", "rating NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')"),
    ("between", "release_year", "TRY_CAST(release_year AS INTEGER) NOT BETWEEN 1800 AND 2026"),
    ("min_length", "title", "length(title) < 1"),
    ("complete", "country", "country IS NULL OR trim(country) = ''"),
    ("complete", "listed_in", "listed_in IS NULL OR trim(listed_in) = ''"),
    ("complete", "description", "description IS NULL OR trim(description) = ''"),
    ("unique", "show_id", "n > 1"),
    ("column_set", "", "false"),
    ("of_type", "release_year", "false"),
]
SUITE = (
    ",\nrepeats AS (SELECT show_id, count(*) AS n FROM raw GROUP BY show_id),\nkeyed AS (SELECT raw.*, n FROM raw LEFT JOIN repeats USING (show_id)),\n"
    "suite_rows AS (\n"
    + "\nUNION ALL ".join(
        f"SELECT '{kind}' AS expectation, '{c}' AS column_name, count(*) AS evaluated, count(*) FILTER ({cond}) AS failed, count(*) FILTER ({cond}) = 0 AS success FROM keyed"
        for kind, c, cond in _CHECKS
    )
    + ")\n"
)


@query(over_raw(SUITE + "SELECT * FROM suite_rows"))
def quality_suite(spark, sf):
    return quality.run_suite(lake.bronze(spark, sf), RULES)


@query(
    over_raw(
        SUITE
        + "SELECT count(*) AS evaluated_expectations, count(*) FILTER (success) AS successful_expectations, "
        "count(*) FILTER (NOT success) AS unsuccessful_expectations, bool_and(success) AS success FROM suite_rows"
    )
)
def quality_suite_summary(spark, sf):
    return quality.suite_summary(quality.run_suite(lake.bronze(spark, sf), RULES))


@query(over_raw(JUDGED + "SELECT show_id, title, array_to_string(reasons, ', ') AS reason_for_failure FROM judged WHERE len(reasons) > 0"))
def rejected_records(spark, sf):
    _, rejected = quality.dq_split(lake.bronze(spark, sf), RULES)
    return rejected.select("show_id", "title", "reason_for_failure")


@query(over_raw(JUDGED + 'SELECT show_id, type, title, director, "cast", country, date_added, release_year, rating, duration, listed_in, description FROM judged WHERE len(reasons) = 0'))
def passed_records(spark, sf):
    passed, _ = quality.dq_split(lake.bronze(spark, sf), RULES)
    return passed.select(*RAW_COLUMNS)


@query(over_raw(JUDGED + "SELECT reason, count(*) AS rejected_rows FROM (SELECT unnest(reasons) AS reason FROM judged) GROUP BY reason"))
def reject_reason_breakdown(spark, sf):
    _, rejected = quality.dq_split(lake.bronze(spark, sf), RULES)
    return quality.reason_breakdown(rejected)


DOCUMENT_RULES = {
    "null_checks": ["doc_id", "text"],
    "unique_checks": ["doc_id"],
    "value_sets": {"lang": ["en", "de", "fr"]},
    "ranges": {"n_chars": (50, 10000)},
    "min_lengths": {"text": 100},
    "completeness_checks": ["source"],
}


@query(
    """
WITH k AS (SELECT documents.*, count(*) OVER (PARTITION BY doc_id) AS n FROM documents)
SELECT expectation, column_name, evaluated, failed, failed = 0 AS success FROM (
  SELECT 'not_null' AS expectation, 'doc_id' AS column_name, count(*) AS evaluated, count(*) FILTER (doc_id IS NULL) AS failed FROM k
  UNION ALL SELECT 'not_null', 'text', count(*), count(*) FILTER (text IS NULL) FROM k
  UNION ALL SELECT 'in_set', 'lang', count(*), count(*) FILTER (lang NOT IN ('en', 'de', 'fr')) FROM k
  UNION ALL SELECT 'between', 'n_chars', count(*), count(*) FILTER (n_chars NOT BETWEEN 50 AND 10000) FROM k
  UNION ALL SELECT 'min_length', 'text', count(*), count(*) FILTER (length(text) < 100) FROM k
  UNION ALL SELECT 'complete', 'source', count(*), count(*) FILTER (source IS NULL OR trim(source) = '') FROM k
  UNION ALL SELECT 'unique', 'doc_id', count(*), count(*) FILTER (n > 1) FROM k)"""
)
def document_quality(spark, sf):
    return quality.run_suite(table(spark, sf, "documents"), DOCUMENT_RULES)
