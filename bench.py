"""Benchmark of the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``; every query is executed in full into the ``noop``
sink (no driver collect). One warm-up pass, then ``$BENCH_RUNS`` timed runs
(default 5; no further run starts after ``$BENCH_BUDGET_S`` seconds); the
median per query is reported. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tripmart.plans.catalog import QUERIES  # noqa: E402
from tripmart.session import build_session  # noqa: E402

HEADLINE = [
    "silver_trips",
    "fact_trip",
    "gold_daily_provider",
    "gold_location",
    "gold_shared_ride",
    "dq_report",
    "run_month_report",
    "incremental_two_months",
]


def run_once(spark, key: str, sf: str, group: str | None = None) -> float:
    if group:
        spark.sparkContext.setJobGroup(group, key)
    t0 = time.perf_counter()
    QUERIES[key](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    keys = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    for k in keys:  # warm-up: JIT, file listing caches
        run_once(spark, k, sf)
    times = {k: [] for k in keys}
    jobs = {}
    began, budget, done = time.perf_counter(), float(os.environ.get("BENCH_BUDGET_S", "420")), 0
    for r in range(runs):
        if r and time.perf_counter() - began > budget:
            break
        done += 1
        for k in keys:
            group = f"bench-{r}-{k}"
            times[k].append(run_once(spark, k, sf, group))
            jobs[k] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    med = {k: round(statistics.median(v), 3) for k, v in times.items()}
    sf_label = sf.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(med.values()), 3),
        "unit": "sec",
        "queries": med,
        "spark_jobs": jobs,
        "sf": float(sf_label) if sf_label.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "runs": done,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
