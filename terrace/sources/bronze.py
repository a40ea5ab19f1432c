"""Bronze landing: raw columns untouched, audit columns added."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame

from terrace.operators.tables import stamp_audit
from terrace.sources import sinks


def land(raw: DataFrame, path: str, system: str, source: Mapping[str, Any], *, batch_id: str, run_id: str, now: datetime) -> None:
    load_type = source.get("load_type", "FULL")
    stamped = stamp_audit(
        raw,
        batch_id=batch_id,
        run_id=run_id,
        source_system=system,
        source_file=source.get("path") or source.get("url") or source.get("table", "unknown"),
        load_type=load_type,
        now=now,
    )
    sinks.write_bronze(stamped, path, load_type)
