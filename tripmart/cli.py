"""spark-submit entry: run landed months through all stages and print the quality report.

    spark-submit tripmart/cli.py --raw s3a://landing/trips --root s3a://lake/trips \\
        --lookup s3a://landing/zones.csv [--months 2026-01 2026-02] [--mode skip|replace] [--format parquet]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tripmart.config import Settings, Tables
from tripmart.plans.monthly import MonthRunner, landing_months
from tripmart.session import cluster_settings, prepare
from tripmart.sources import readers


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--raw", required=True, help="landing root holding raw/month=yyyy-MM/")
    p.add_argument("--root", required=True, help="root folder of the persisted tables")
    p.add_argument("--lookup", help="zone lookup CSV (LocationID, Borough, Zone, service_zone)")
    p.add_argument("--months", nargs="*", help="months to run; default: every landed month")
    p.add_argument("--mode", choices=["skip", "replace"], default="skip")
    p.add_argument("--format", default="parquet")
    p.add_argument("--dispatch-keys", choices=["natural", "surrogate"], default="natural")
    a = p.parse_args(argv)
    spark = prepare(SparkSession.builder.appName("tripmart").getOrCreate())
    fs, path = readers.file_system(spark, a.raw)
    landed = fs.getContentSummary(path).getLength()
    for key, value in cluster_settings(landed, spark.sparkContext.defaultParallelism).items():
        spark.conf.set(key, value)
    months = a.months or landing_months(spark, a.raw)
    runner = MonthRunner(spark, Tables(root=a.root, fmt=a.format), a.raw,
                         Settings(load_mode=a.mode, dispatch_key_mode=a.dispatch_keys), lookup_csv=a.lookup)
    report = runner.run(months)
    report = report.orderBy("source_month", F.length("check_id"), "check_id").cache()
    report.show(max(1, report.count()), truncate=False)  # twelve rows a month


if __name__ == "__main__":
    main()
