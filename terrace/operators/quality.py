"""Rule-driven data quality (Q1-Q13).

Rules are a plain dict:

    required_columns, null_checks, unique_checks, type_checks, integer_columns,
    date_columns {col: format}, value_sets {col: [..]},
    ranges {col: (low, high)}, max_values {col: high},
    not_blank, min_lengths {col: n}, completeness_checks

and compile to column expressions, so a whole suite is one scan plus one
map-side-combined count per unique key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from terrace.functions.text import parse_date, safe_int
from terrace.operators.tables import by_rows

Rules = Mapping[str, Any]


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def column_set_check(df: DataFrame, expected: Sequence[str], ignore: Sequence[str] = ()) -> dict[str, list[str]]:
    """Q1: expected columns that are missing and columns nobody expected. Needs no job."""
    return {
        "missing": [c for c in expected if c not in df.columns],
        "unexpected": [c for c in df.columns if c not in expected and c not in ignore],
    }


def _failures(df: DataFrame, rules: Rules) -> dict[tuple[str, str], Column]:
    """(expectation, column) -> condition under which a row breaks it (Q2, Q4-Q8)."""
    out: dict[tuple[str, str], Column] = {}
    for c in rules.get("null_checks", []):
        out["not_null", c] = F.col(c).isNull()
    for c in rules.get("integer_columns", []):
        out["castable_to_int", c] = F.col(c).isNotNull() & safe_int(F.col(c)).isNull()
    for c, fmt in rules.get("date_columns", {}).items():
        out["date_format", c] = F.col(c).isNotNull() & parse_date(F.col(c), fmt).isNull()
    for c, allowed in rules.get("value_sets", {}).items():
        out["in_set", c] = F.col(c).isNotNull() & ~F.col(c).isin(list(allowed))
    for c, (low, high) in rules.get("ranges", {}).items():
        number = safe_int(F.col(c)) if dict(df.dtypes)[c] == "string" else F.col(c)
        out["between", c] = number.isNotNull() & ~number.between(low, high)
    for c, n in rules.get("min_lengths", {}).items():
        out["min_length", c] = F.col(c).isNotNull() & (F.length(F.col(c)) < n)
    for c in rules.get("completeness_checks", []):
        out["complete", c] = _blank(F.col(c))
    return out


def run_suite(df: DataFrame, rules: Rules) -> DataFrame:
    """Q9: one row per expectation: expectation, column_name, evaluated, failed, success.

    ``evaluated`` is the row count. The column-set and type expectations
    compare schemas and have no failing rows of their own.
    """
    failures = _failures(df, rules)
    known: dict[tuple[str, str], bool] = {}
    if "required_columns" in rules:
        diff = column_set_check(df, rules["required_columns"], rules.get("ignore_columns", ()))
        known["column_set", ",".join(diff["missing"] + diff["unexpected"])] = any(diff.values())
    types = dict(df.dtypes)
    for c, expected in rules.get("type_checks", {}).items():
        known["of_type", c] = types.get(c) != expected

    def entry(kind: str, c: str, failed: Column) -> Column:
        return F.struct(F.lit(kind).alias("expectation"), F.lit(c).alias("column_name"), failed.cast("long").alias("failed"))

    parts: list[DataFrame] = []
    if failures or known:
        counts = df.agg(
            F.count("*").alias("evaluated"), *(F.count_if(cond).alias(f"_{i}") for i, cond in enumerate(failures.values()))
        )
        entries = [entry(kind, c, F.col(f"_{i}")) for i, (kind, c) in enumerate(failures)]
        entries += [entry(kind, c, F.lit(int(broken))) for (kind, c), broken in known.items()]
        parts.append(
            counts.select("evaluated", F.inline(F.array(*entries))).select("expectation", "column_name", "evaluated", "failed")
        )
    for c in rules.get("unique_checks", []):
        per_key = df.groupBy(c).agg(F.count("*").alias("_n"))
        repeated = F.col(c).isNotNull() & (F.col("_n") > 1)
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("evaluated"),
                F.coalesce(F.sum(F.when(repeated, F.col("_n"))), F.lit(0)).alias("failed"),
            ).select(F.lit("unique").alias("expectation"), F.lit(c).alias("column_name"), "evaluated", "failed")
        )
    if not parts:
        raise ValueError("the rules name no expectation")
    rows = reduce(DataFrame.unionByName, parts)
    return rows.withColumn("success", F.col("failed") == 0)


def suite_summary(suite: DataFrame) -> DataFrame:
    """Q9: evaluated / successful / unsuccessful totals and overall success, from :func:`run_suite` rows."""
    return suite.agg(
        F.count("*").alias("evaluated_expectations"),
        F.count_if(F.col("success")).alias("successful_expectations"),
        F.count_if(~F.col("success")).alias("unsuccessful_expectations"),
        F.bool_and("success").alias("success"),
    )


def reject_reasons(rules: Rules, repeats: Mapping[str, Column]) -> Column:
    """Q10: array of the messages a row earns, in rule order.

    ``repeats`` gives, per unique column, the condition that its value occurs
    more than once.
    """
    messages: list[Column] = []

    def add(condition: Column, message: str) -> None:
        messages.append(F.when(condition, F.lit(message)))

    # The reject messages are part of the output contract.
    for c in rules.get("null_checks", []):
        add(F.col(c).isNull(), f"Null value in required column '{c}'")
    for c, repeated in repeats.items():
        add(repeated, f"Duplicate {c} key value")
    for c in rules.get("integer_columns", []):
        add(F.col(c).isNotNull() & safe_int(F.col(c)).isNull(), f"{c} datatype is not castable to integer")
    for c, fmt in rules.get("date_columns", {}).items():
        add(F.col(c).isNotNull() & parse_date(F.col(c), fmt).isNull(), f"{c} has invalid date format")
    for c, allowed in rules.get("value_sets", {}).items():
        message = {"type": "Invalid type (not Movie or TV Show)", "rating": "Invalid rating categorization"}.get(c, f"Invalid {c}")
        add(F.col(c).isNotNull() & ~F.col(c).isin(list(allowed)), message)
    for c, high in rules.get("max_values", {}).items():
        add(safe_int(F.col(c).cast("string")) > high, f"{c} cannot be in the future")
    for c in rules.get("not_blank", []):
        add(_blank(F.col(c)), f"{c} cannot be empty")
    for c, n in rules.get("min_lengths", {}).items():
        add(F.length(F.trim(F.col(c))) < n, f"{c} length is 0")
    for c in rules.get("completeness_checks", []):
        add(_blank(F.col(c)), f"Required field '{c}' is blank or empty")
    return F.filter(F.array(*messages), lambda m: m.isNotNull())


def with_reasons(df: DataFrame, rules: Rules) -> DataFrame:
    """Every row with its ``reasons`` array; rows with a NULL key are never duplicates.

    Repeated keys are found by a map-side-combined count and joined back, so a
    hot key never has to sit in one task: the join keeps the rows on its left
    side, which adaptive skew handling may split.
    """
    columns = df.columns
    repeats: dict[str, Column] = {}
    for c in rules.get("unique_checks", []):
        mark = f"_repeat_{c}"
        repeated = (
            df.filter(F.col(c).isNotNull())
            .groupBy(c)
            .agg(F.count("*").alias("_n"))
            .filter(F.col("_n") > 1)
            .select(c, F.lit(True).alias(mark))
        )
        df = df.join(by_rows(repeated), c, "left")
        repeats[c] = F.col(mark).isNotNull()
    return df.select(*columns, reject_reasons(rules, repeats).alias("reasons"))


def dq_split(df: DataFrame, rules: Rules, observe: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """Q11: (passed rows, rejected rows with ``reasons`` and ``reason_for_failure``).

    With ``observe`` the pass and fail counts are collected by whichever
    action reads the annotated frame first, instead of by two more jobs.
    """
    judged = with_reasons(df, rules)
    bad = F.size("reasons") > 0
    if observe is not None:
        judged = judged.observe(observe, F.count_if(~bad).alias("passed"), F.count_if(bad).alias("rejected"))
    passed = judged.filter(~bad).drop("reasons")
    rejected = judged.filter(bad).withColumn("reason_for_failure", F.concat_ws(", ", "reasons"))
    return passed, rejected


def reason_breakdown(rejected: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Q13: how often each reason occurs (per batch, with ``by``)."""
    return rejected.select(*by, F.explode("reasons").alias("reason")).groupBy(*by, "reason").agg(F.count("*").alias("rejected_rows"))


def orphan_counts(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Q12: fact rows without a member in each dimension, as (constraint_name, violations).

    Fact keys are counted per value before the anti join, so a hot key is one row.
    """
    parts = []
    for name, (dim, key) in dims.items():
        used = fact.groupBy(key).agg(F.count("*").alias("_n"))
        parts.append(
            used.join(by_rows(dim.select(key)), key, "left_anti")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations"))
            .select(F.lit(f"fk_{name}").alias("constraint_name"), "violations")
        )
    return reduce(DataFrame.unionByName, parts)


def uniqueness_counts(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Q12: keys that occur more than once or are NULL in each table, as (constraint_name, violations)."""
    parts = []
    for name, (df, keys) in tables.items():
        missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        parts.append(
            df.groupBy(*keys)
            .agg(F.count("*").alias("_n"))
            .agg(F.count_if((F.col("_n") > 1) | missing).alias("violations"))
            .select(F.lit(f"pk_{name}").alias("constraint_name"), "violations")
        )
    return reduce(DataFrame.unionByName, parts)
