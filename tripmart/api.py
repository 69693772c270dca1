"""The reference's public functions, one month at a time, over the batch runner.

Same names and call order as the reference's API surface so existing callers
can switch; table names and the landing root live in ``Tables`` /
``raw_base`` instead of being hard-coded. Differences (SURVEY 2.15):
stages never return None (a skipped month returns the persisted slice), the
quality result carries the observed count in the report table and is also
returned as (check, status) pairs like before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.config import Settings, Tables
from tripmart.plans.monthly import MonthRunner


def _runner(spark: SparkSession, tables: Tables, raw_base: str = "", settings: Settings = Settings(),
            lookup_csv: str | None = None) -> MonthRunner:
    return MonthRunner(spark, tables, raw_base, settings, lookup_csv=lookup_csv)


def _slice(r: MonthRunner, name: str, month: str) -> DataFrame:
    return r._read(name).where(F.col("_source_month") == month)


def ingest_month_to_bronze(spark: SparkSession, raw_base: str, source_month: str, tables: Tables,
                           settings: Settings = Settings()) -> int:
    """Rows ingested; 0 when the month was already loaded (skip mode)."""
    r = _runner(spark, tables, raw_base, settings)
    done = r.bronze([source_month])
    return next((x.rows for x in r.results if x.stage == "bronze" and x.status == "loaded"), 0) if done else 0


def transform_month_to_silver(spark: SparkSession, source_month: str, tables: Tables,
                              settings: Settings = Settings()) -> DataFrame:
    r = _runner(spark, tables, settings=settings)
    r.silver([source_month])
    return _slice(r, "silver", source_month)


def update_dispatch_dimension(spark: SparkSession, source_month: str, tables: Tables,
                              settings: Settings = Settings(), lookup_csv: str | None = None) -> DataFrame:
    """Also extends the provider and date dimensions from the month (the reference left them stale)."""
    r = _runner(spark, tables, settings=settings, lookup_csv=lookup_csv)
    r.dimensions([source_month])
    return r._read("dim_dispatch")


def build_month_to_fact(spark: SparkSession, source_month: str, tables: Tables,
                        settings: Settings = Settings()) -> DataFrame:
    r = _runner(spark, tables, settings=settings)
    r.fact([source_month])
    return _slice(r, "fact", source_month)


def build_daily_provider_gold(spark: SparkSession, source_month: str, tables: Tables,
                              settings: Settings = Settings()) -> DataFrame:
    """Stores the month's partial and rewrites the mart tables; returns the daily mart."""
    r = _runner(spark, tables, settings=settings)
    r.mart_partials([source_month])
    r.publish()
    return r._read("gold_daily")


def build_location_gold(spark: SparkSession, tables: Tables) -> DataFrame:
    """Rewrites the mart table from the stored partials and returns it."""
    r = _runner(spark, tables)
    r.publish()
    return r._read("gold_location")


def build_shared_ride_gold(spark: SparkSession, tables: Tables) -> DataFrame:
    r = _runner(spark, tables)
    r.publish()
    return r._read("gold_shared")


def run_data_quality_checks(spark: SparkSession, source_month: str, tables: Tables) -> list[tuple[str, str]]:
    """(check, status) pairs of one month, as before; the full report is ``MonthRunner.checks``."""
    rows = _runner(spark, tables).checks([source_month]).where(F.col("check_id") != "N12").orderBy(
        F.length("check_id"), "check_id").collect()
    return [(x["check_name"], x["status"]) for x in rows]


def run_month(spark: SparkSession, source_month: str, tables: Tables, raw_base: str,
              settings: Settings = Settings(), lookup_csv: str | None = None) -> list[tuple[str, str]]:
    """Bronze -> Silver -> dimensions -> fact -> marts -> checks for one month."""
    r = _runner(spark, tables, raw_base, settings, lookup_csv)
    rep = r.run([source_month]).where(F.col("check_id") != "N12").orderBy(F.length("check_id"), "check_id")
    return [(x["check_name"], x["status"]) for x in rep.collect()]
