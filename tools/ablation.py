"""

1. quality: 13 separate actions (reference style) vs the fused report (one collect)
2. daily mart: join-then-aggregate (reference) vs aggregate-then-join (ours)
3. marts after a new month: full rebuild over the whole fact vs one month partial + roll-up

Usage: python tools/ablation.py [sf_dir] -> prints one JSON line (median of 3 runs, seconds).
"""

from __future__ import annotations

import json
import statistics
import sys
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from tripmart.operators import marts, quality  # noqa: E402
from tripmart.plans.catalog import Inputs  # noqa: E402
from tripmart.session import build_session  # noqa: E402


def med(f, n=3):
    f()
    ts = []
    for _ in range(n):
        t = time.perf_counter()
        f()
        ts.append(time.perf_counter() - t)
    return round(statistics.median(ts), 3)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]")
    i = Inputs(spark, sf)
    silver = i.silver_table
    fact = i.materialize(i.fact, "fact")
    month = sorted(r[0] for r in fact.select("_source_month").distinct().collect())[-1]
    loc = marts.location(fact, i.dim_location)
    shared = marts.shared_ride(fact, i.dim_provider)
    daily = marts.daily_provider(marts.partials(fact, marts.DAILY_GRAIN), i.dim_date, i.dim_provider)
    noop = lambda df: df.write.format("noop").mode("overwrite").save()

    def separate_actions():
        s = silver.where(F.col("_source_month") == month)
        f = fact.where(F.col("_source_month") == month)
        s.count()
        f.count()
        f.groupBy("trip_key").count().where("count > 1").count()
        for c in ["provider_key", "pickup_location_key", "dropoff_location_key", "dispatching_base_key"]:
            f.where(F.col(c).isNull()).count()
        f.where(F.col("timestamp_quality_flag") == "ISSUE").count()
        f.where(F.col("financial_quality_flag") == "ISSUE").count()
        daily.where(F.date_format("date", "yyyy-MM") == month).agg(F.sum("total_trips")).first()
        loc.agg(F.sum("total_trips")).first()
        fact.count()
        shared.agg(F.sum("total_trips")).first()

    def fused():
        s = silver.where(F.col("_source_month") == month)
        f = fact.where(F.col("_source_month") == month)
        lt, st = quality.mart_totals(loc, shared)
        quality.with_overall(quality.report(s, f, daily, lt, st, total_fact_rows=fact.count())).collect()

    def join_then_agg():
        j = fact.join(i.dim_provider.select("provider_key", "provider_name"), "provider_key", "left").join(
            i.dim_date.select("date_key", "date"), "date_key", "left")
        noop(j.groupBy("date_key", "date", "provider_key", "provider_name").agg(*marts.trip_partials()))

    def agg_then_join():
        noop(marts.daily_provider(marts.partials(fact, marts.DAILY_GRAIN), i.dim_date, i.dim_provider))

    grain = ["_source_month", "date_key", "provider_key", "pickup_location_key"]
    parts = i.materialize(marts.partials(fact.where(F.col("_source_month") != month), grain), "ablation_parts")

    def full_rebuild():
        noop(marts.location(fact, i.dim_location))
        noop(marts.shared_ride(fact, i.dim_provider))

    def month_partial():
        new = marts.partials(fact.where(F.col("_source_month") == month), grain)
        allp = parts.unionByName(new)
        noop(marts.rollup(allp, ["pickup_location_key"]))
        noop(marts.rollup(allp, ["provider_key"]))

    out = {
        "sf": sf,
        "quality_13_separate_actions": med(separate_actions),
        "quality_fused_report": med(fused),
        "daily_join_then_aggregate": med(join_then_agg),
        "daily_aggregate_then_join": med(agg_then_join),
        "marts_full_rebuild": med(full_rebuild),
        "marts_month_partial_rollup": med(month_partial),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
