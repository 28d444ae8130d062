"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_QUERIES (names,
or "all").
"""

from __future__ import annotations

import json
import os
import platform
import time

import pyspark

from careledger.queries import QUERIES
from careledger.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "parse_value", "ethiopian_date", "ghost_delete", "ghost_report", "keep_last", "upsert_values",
    "upsert_newer_only", "insert_if_absent", "orgunit_flatten", "subtree_filter", "since_filter",
    "missing_periods", "reporting_pivot", "work_reporting", "work_completeness", "manifest_reporting",
    "manifest_completeness", "batch_rows", "category_dimension", "explode_values", "grid_payload",
    "element_payload", "combo_entities", "finished_units", "load_values", "load_rates",
    "incremental_values", "clean_ghosts",
)


def main() -> None:
    spark = local_session(CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    QUERIES["keep_last"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
        "spark": pyspark.__version__,
        "machine": platform.machine(),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
