"""Time the headline queries: prints one JSON line. ``python bench.py [query ...]`` or ``all``."""

from __future__ import annotations

import json
import os
import sys
import time

from benchledger.queries import QUERIES
from benchledger.session import build_session

HEADLINE = (
    "report_results", "report_window_results", "runs_joined", "parse_outputs", "derived_metrics",
    "build_tallies", "app_build_tallies", "latest_builds",
    "first_parent_log", "first_parent_range", "log_to_date", "commit_sample",
    "needed_tasks", "tasks_to_run", "coverage_counts", "plan_order_date", "budgeted_plan", "rebuild_points",
    "skip_reasons", "report_lines", "branch_series",
    "sample_totals", "sample_stats", "sample_percentiles", "warmup_excluded",
    "cap_output", "ingest_records", "stream_latest_results", "stream_sample_rollup",
)


def main(arguments: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cores}]",
        **{
            "spark.sql.shuffle.partitions": cores,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = list(QUERIES) if arguments == ["all"] else arguments or list(HEADLINE)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # The first query pays for starting the workers and for deriving the stored input tables.
    warm_up = run("commit_sample")
    seconds = {name: round(run(name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
                "cores": int(cores),
                "warm_up": round(warm_up, 3),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
