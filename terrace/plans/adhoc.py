"""Read-only ad-hoc SQL over the registered views."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession


# Functions that run Java code by name, and words that start statements the parser could take for a table.
REFLECTION = {"java_method", "reflect", "try_reflect"}
STATEMENTS = {"show", "describe", "desc", "explain", "list", "refresh"}


class NotAQuery(ValueError):
    """The statement is something other than a query."""


def query_readonly(spark: SparkSession, sql: str) -> DataFrame:
    """Run a query; refuse any other statement.

    Only a query can stand as a derived table, so Spark's parser itself tells
    them apart; a keyword such as DROP inside a string literal does no harm.
    Nothing runs while a statement is being refused: commands never get as far
    as analysis.
    """
    text = sql.strip().rstrip(";").rstrip()
    wrapped = f"SELECT * FROM (\n{text}\n) AS q"
    try:
        parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(wrapped)
    except Exception as err:  # the parser's own exception class is not exposed here
        raise NotAQuery(f"only a single query is allowed: {err}") from err
    nodes = list(_nodes(json.loads(parsed.toJSON())))
    _refuse_outside(spark, nodes)
    if text.split(None, 1)[0].lower() in STATEMENTS:
        raise NotAQuery(f"only a single query is allowed, not {text.split(None, 1)[0].upper()}")
    try:
        return spark.sql(wrapped)
    except ParseException as err:
        raise NotAQuery(f"only a single query is allowed: {err}") from err


def _nodes(value: Any) -> Iterator[dict]:
    """All plan nodes and expressions below a plan's JSON form, nested plans included."""
    if isinstance(value, dict):
        if "class" in value:
            yield value
        for v in value.values():
            yield from _nodes(v)
    elif isinstance(value, list):
        for v in value:
            yield from _nodes(v)


def _refuse_outside(spark: SparkSession, nodes: list[dict]) -> None:
    """Nothing that starts processes, calls Java, or reads files that are not registered as a view or table."""
    for node in nodes:
        kind = node["class"].rsplit(".", 1)[-1]
        if kind in ("ScriptTransformation", "CallMethodViaReflection", "TryReflect"):
            raise NotAQuery("scripts and Java calls are not allowed")
        if kind in ("UnresolvedFunction", "UnresolvedTableValuedFunction"):
            name = _names(node.get("nameParts") or node.get("name"))
            if name and name[-1].lower() in REFLECTION:
                raise NotAQuery(f"{name[-1]} is not allowed")
        if kind == "UnresolvedRelation":
            name = _names(node.get("multipartIdentifier"))
            if len(name) > 1 and not spark.catalog.databaseExists(name[-2]):
                raise NotAQuery(f"only registered views and tables can be read, not {'.'.join(name)}")


def _names(value: Any) -> list[str]:
    """The parts of a name in a plan's JSON form: a list, or text like ``[a, b]``."""
    if isinstance(value, str):
        value = value.strip("[]").split(",")
    return [str(v).strip() for v in value or []]
