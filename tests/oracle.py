"""Compare registered queries with their SQL: columns, types, row counts and values."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "array<string>": "VARCHAR[]",
}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def compare(spark, con, name, fn, sql, sf) -> list[str]:
    """Differences between a query and its SQL; empty when they agree."""
    df = fn(spark, sf)
    cols = sorted(df.columns)
    mine = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    rel = con.execute(sql)
    desc = [d[0] for d in rel.description]
    kinds = {d[0]: str(d[1]) for d in rel.description}
    rows = rel.fetchall()
    problems = []
    if sorted(desc) != cols:
        return [f"columns {cols} vs {sorted(desc)}"]
    for c, t in df.dtypes:
        if TYPES.get(t, t) != kinds[c]:
            problems.append(f"type of {c}: {t} vs {kinds[c]}")
    at = [desc.index(c) for c in cols]
    theirs = [tuple(_norm(r[i]) for i in at) for r in rows]
    a, b = Counter(mine), Counter(theirs)
    if a != b:
        problems.append(f"rows {len(mine)} vs {len(theirs)}; only ours {list((a - b))[:3]}; only SQL {list((b - a))[:3]}")
    return problems


def main() -> None:
    from suite import all_oracles, all_queries
    from terrace.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    oracles, bad = all_oracles(), 0
    for name, fn in all_queries().items():
        if only and not any(o in name for o in only):
            continue
        start = time.time()
        try:
            if name in oracles:
                problems = compare(spark, con, name, fn, oracles[name], sf)
            else:
                problems = [] if fn(spark, sf).count() else ["no rows"]
        except Exception as err:  # report and go on with the others
            problems = [f"{type(err).__name__}: {str(err)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s {'' if name in oracles else '(rows only)'}", *problems, sep="\n     " if problems else " ", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
