"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  tables to read (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from suite import all_queries, lake  # noqa: E402
from terrace.session import build_session  # noqa: E402

HEADLINE = [
    "quality_suite_summary",
    "rejected_records",
    "silver_load_metrics",
    "general_summary",
    "country_distribution_view",
    "director_distribution_view",
    "country_profile",
    "executive_row",
    "metric_values",
    "kpi_country_summary",
    "country_distribution",
    "top_genres_by_country",
    "director_rankings",
    "yearly_releases",
    "titles_enriched",
    "latest_order_lines",
    "top_part_types_by_nation",
    "grain_report",
    "scd1_customers",
    "scd2_customers_twice",
    "scd2_stored_merge",
    "order_forecast",
    "isolation_outliers",
    "director_clusters",
    "incremental_titles",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start-up is not measured

    only = sys.argv[1:]
    queries, times = all_queries(), {}
    times["build_bronze"] = timed(lambda: lake.bronze(spark, sf))
    times["build_silver"] = timed(lambda: lake.titles(spark, sf))
    times["build_gold"] = timed(lambda: lake.star(spark, sf))
    for name in HEADLINE:
        if not only or any(o in name for o in only):
            times[name] = timed(lambda: queries[name](spark, sf).write.format("noop").mode("overwrite").save())
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds, raw tables to gold and headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf.rsplit("sf", 1)[-1]),
            }
        )
    )


if __name__ == "__main__":
    main()
