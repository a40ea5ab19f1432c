"""Registered queries: each Spark callable sits next to the SQL that must give the same rows."""

from importlib import import_module

from suite.registry import ORACLES, QUERIES

MODULES = ["kpis", "columns", "aggregates", "storage", "checks", "history", "runs", "statistics", "metricset"]


def _load() -> None:
    for name in MODULES:
        import_module(f"suite.{name}")


def all_queries():
    _load()
    return dict(QUERIES)


def all_oracles():
    _load()
    return dict(ORACLES)
