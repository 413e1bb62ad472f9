"""Time the headline queries and print one JSON line.

BENCH_SF_DIR    input folder (default /root/testdata/sf0.1)
BENCH_CPUS      local threads (default: all)
BENCH_RUNS      timed runs after one warm-up, the median counts (default 3)
BENCH_QUERIES   comma-separated names, or "all" (default: the headline queries)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from harness.queries import QUERIES  # noqa: E402

HEADLINE = ("dedup_events", "events_raw", "events_rollup", "forced_null_rollup",
            "install_first_open", "cohort_rollup", "crash_rollup", "app_health_table")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = list(QUERIES) if names == "all" else names.split(",") if names else list(HEADLINE)
    threads = os.cpu_count() if cpus == "*" else int(cpus)
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", str(threads))
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timings = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timings[1:]), 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds,
                      "sf": float(Path(sf_dir).name.removeprefix("sf"))}))


if __name__ == "__main__":
    main()
