"""Configured sources (S1-S8). Every reader is lazy and runs on executors.

A source is a dict: ``format`` (csv, json, xml, jdbc, payload, parquet),
``path`` or ``table``/``url``, optional ``schema`` (DDL or StructType),
``options`` and ``load_type``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.sources import bronze


class SourceError(ValueError):
    """A source that is unknown, misconfigured or absent."""


# Option sets of the catalog's file formats. Files split over tasks; a source whose records span lines
# (quoted line breaks, one JSON array) asks for ``multiLine`` in its own options.
FORMAT_OPTIONS: dict[str, dict[str, str]] = {
    "csv": {"header": "true", "delimiter": ",", "quote": '"', "escape": '"'},
    "json": {},
    "xml": {"rowTag": "row"},
    "parquet": {},
}


def string_schema(cols: Iterable[str]) -> T.StructType:
    """All-string schema for a raw file."""
    return T.StructType([T.StructField(c, T.StringType()) for c in cols])


def _read_file(spark: SparkSession, cfg: Mapping[str, Any]) -> DataFrame:
    fmt = cfg["format"].lower()
    reader = spark.read.format(fmt).options(**{**FORMAT_OPTIONS[fmt], **cfg.get("options", {})})
    if cfg.get("schema") is not None:
        reader = reader.schema(cfg["schema"])
    try:
        return reader.load(cfg["path"])
    except AnalysisException as err:
        raise SourceError(f"cannot read {fmt} source at {cfg['path']}: {err}") from err


def jdbc_options(cfg: Mapping[str, Any]) -> dict[str, str]:
    """Reader options of a JDBC source. ``partition_column`` with its bounds splits the scan over tasks."""
    options = {"url": cfg["url"], "dbtable": cfg["table"], **cfg.get("connection_properties", {})}
    if "partition_column" in cfg:
        options |= {
            "partitionColumn": cfg["partition_column"],
            "lowerBound": str(cfg["lower_bound"]),
            "upperBound": str(cfg["upper_bound"]),
            "numPartitions": str(cfg.get("num_partitions", 32)),
        }
    options["fetchsize"] = str(cfg.get("fetch_size", 10_000))
    return options


def _parsed(col: str, schema: T.StructType | str) -> Column:
    struct = schema if isinstance(schema, str) else schema.simpleString()
    if not struct.startswith("struct<"):
        struct = f"struct<{struct}>"
    return F.from_json(F.col(col), f"array<{struct}>")


def _damaged(col: str, rows: Column) -> Column:
    """No body, no parse, or fewer objects than the body's array has elements."""
    elements = F.json_array_length(col)
    complete = F.coalesce(F.size(F.filter(rows, lambda r: r.isNotNull())) == elements, F.size(rows) >= 1)
    return F.col(col).isNull() | rows.isNull() | ~F.coalesce(complete, F.lit(False))


def payloads_to_df(payloads: DataFrame, col: str, schema: T.StructType | str, keep: Iterable[str] = ()) -> DataFrame:
    """JSON response bodies to rows; a body is one object or an array of objects.

    Bodies that cannot be read whole give no rows here; ``bad_payloads`` returns them.
    """
    rows = _parsed(col, schema)
    return payloads.where(~_damaged(col, rows)).select(*keep, F.inline(rows))


def bad_payloads(payloads: DataFrame, col: str, schema: T.StructType | str) -> DataFrame:
    """The bodies that ``payloads_to_df`` leaves out, with all their columns, to be quarantined or fetched again."""
    return payloads.where(_damaged(col, _parsed(col, schema)))


def fetch_payloads(requests: DataFrame, fetch: Callable[[str], str], url: str = "url") -> DataFrame:
    """Call ``fetch(url)`` for each requested URL on executors and keep the body next to it."""

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"url": batch[url], "payload": [fetch(u) for u in batch[url]]})

    return requests.select(url).mapInPandas(call, "url string, payload string")


def read_source(spark: SparkSession, cfg: Mapping[str, Any]) -> DataFrame:
    """A DataFrame over one configured source."""
    fmt = str(cfg.get("format", "")).lower()
    if fmt in FORMAT_OPTIONS:
        return _read_file(spark, cfg)
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(**jdbc_options(cfg)).load()
    if fmt == "payload":
        return payloads_to_df(cfg["payloads"], cfg.get("column", "payload"), cfg["schema"])
    raise SourceError(f"unsupported source format: {fmt!r}")


def pick_sources(cfg: Mapping[str, Any], names: str | Iterable[str]) -> dict[str, Mapping[str, Any]]:
    """The named sources; "all" or a comma list is accepted, an unknown name is an error."""
    known = cfg["sources"]
    if isinstance(names, str):
        names = list(known) if names == "all" else [n.strip() for n in names.split(",") if n.strip()]
    names = list(names)
    unknown = [n for n in names if n not in known]
    if unknown:
        raise SourceError(f"unknown sources: {', '.join(unknown)}")
    return {n: known[n] for n in names}


def ingest(spark: SparkSession, cfg: Mapping[str, Any], names: str | Iterable[str] = "all", **audit: Any) -> dict[str, str]:
    """Land the named sources in bronze, one distributed write each; returns their bronze paths.

    ``cfg`` has ``name``, ``bronze_dir`` and ``sources``; ``audit`` gives
    ``batch_id``, ``run_id`` and ``now``.
    """
    landed = {}
    for name, source in pick_sources(cfg, names).items():
        path = f"{cfg['bronze_dir']}/bronze_{name}"
        bronze.land(read_source(spark, source), path, cfg["name"], source, **audit)
        landed[name] = path
    return landed
