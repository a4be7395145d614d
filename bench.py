"""Time the headline queries: one JSON line with seconds per query and in total."""

from __future__ import annotations

import json
import os
import time

from cdclake.plans.sample_queries import QUERIES
from cdclake.session import build_session

DATA = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
HEADLINE = (
    "validate_rows", "quarantine_rows", "latest_change", "merge_changes", "append_new_rows", "update_existing_rows",
    "mirror_merge", "mirror_rows", "active_archive", "reload_inserts", "reload_updates", "reload_deletes",
    "archive_backfill", "key_mismatches", "key_reconciliation", "counts_by_operation", "change_report", "state_report",
    "latency", "view_person", "view_movement", "stored_merge", "stored_compact", "full_load", "cdc_stream",
    "reload_job_updates",
)


def run(spark, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, DATA).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = build_session(
        "bench", master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": str(CPUS),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    run(spark, names[0])
    seconds = {}
    for name in names:
        # The second run counts: the first one compiles plans and warms the file cache.
        run(spark, name)
        seconds[name] = round(run(spark, name), 3)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(DATA.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
