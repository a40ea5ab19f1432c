"""Session defaults and the shared folder for tables derived during a run."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_local_fallback: dict[str, str] = {}


def build_session(app: str = "terrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session pinned to UTC with adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def workspace(spark: SparkSession) -> str:
    """Folder for derived tables: the cluster's ``spark.checkpoint.dir``, one subfolder per application.

    A machine-local folder is only ever used by a local master that names none.
    """
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if app not in _local_fallback:
            _local_fallback[app] = tempfile.mkdtemp(prefix="terrace-")
        shared = _local_fallback[app]
    return f"{shared.rstrip('/')}/terrace/{app}"
