"""Time the headline queries and print one JSON line.

Every query is run to the end through the noop sink, so all rows are computed and
none travel to the driver.
"""

from __future__ import annotations

import json
import os
import time

from tidemark.plans import catalog
from tidemark.session import local_session

HEADLINE = [
    "stage_users", "scd2_build", "order_history", "scd_current", "scd_state_at", "scd_as_of_join",
    "scd_division_changes", "scd_statistics", "scd_performance", "scd_suite", "q_strict_current",
    "q_gaps", "q_unchanged", "q_overlaps", "dq_profile", "dq_rules", "quarantine", "scd2_merge",
    "lookback_seeded", "merge_stats", "dim_merge", "upsert_latest", "snapshot_timestamp",
    "scd2_apply", "compact", "scheduled_runs", "metric_windows", "metric_alarms", "run_alarms", "metric_gapfill", "error_tail",
    "stream_scd2_history", "stream_metric_windows", "stream_metric_windows_late",
    "heavy_key_history", "suite_after_merge", "alarms_by_dimension", "profile_by_extract",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    # Start executors and class loading before the clock does.
    catalog.QUERIES["stage_users"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        began = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
