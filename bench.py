"""Time the headline queries and print one JSON line.

Every query is built and run to the end twice (its rows go to a sink that drops them) and the faster
run counts, so that compiling a plan for the first time does not. ``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the number of
local cores.
"""

from __future__ import annotations

import contextlib
import json
import os
import re
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chronotable.workloads import QUERIES  # noqa: E402

HEADLINE = [
    "row_md5",
    "hash_all_columns",
    "dedup_events_keep",
    "dedup_events_reject",
    "sorted_by_key",
    "classify_orders",
    "classify_restricted",
    "scd2_open",
    "scd2_events_open",
    "scd2_events_close",
    "scd2_events_reject",
    "scd2_null_key_merge",
    "scd1_upsert",
    "merge_update_all",
    "merge_string_cond",
    "merge_first_clause_wins",
    "merge_upsert_unique",
    "merge_delete",
    "store_open",
    "stream_open",
    "day_partitioned_write",
    "ctas_bucketed",
    "join_on_basename",
    "relocate_entries",
]


def run(query: Callable[[SparkSession, str], DataFrame], spark: SparkSession, sf: str) -> float:
    start = time.perf_counter()
    query(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    with contextlib.redirect_stdout(sys.stderr):
        for name in HEADLINE:
            seconds[name] = round(min(run(QUERIES[name], spark, sf_dir) for _ in range(2)), 3)
    spark.stop()
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
