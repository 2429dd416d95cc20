"""Times the headline queries on whole tables and prints one JSON line.

Each query is run once to warm up (code generation, file cache) and once timed, from building its plan to writing every
output row to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tideline.session import build_session
from workload.queries import QUERIES

HEADLINE = (
    "feature_panel", "long_history", "daily_forecast", "rolling_state", "dedup_last_per_day", "asof_daily",
    "days_unchanged", "rolling_gap", "peer_gap", "segment_report", "classification_report", "radius_search",
    "radius_join", "publish_snapshot", "train_evaluate",
)


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", "tideline-bench",
        spark__sql__shuffle__partitions=str(max(8, int(cpus) if cpus.isdigit() else 8)),
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        timings[name] = round(run(spark, name, sf_dir), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
