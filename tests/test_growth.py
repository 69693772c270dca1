"""Writes and shuffles that grow with the input only: codec, columns that are shuffled, no sort by month."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tripmart.plans import catalog
from tripmart.session import HASH_JOINS, scratch_root
from tripmart.sources import fixture, readers, sinks

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_landing_shuffles_the_joined_columns_not_the_trip_columns(spark):
    lines = _plan(fixture._by_month(spark, SF_SMALL)).splitlines()
    at = next(i for i, x in enumerate(lines) if "RebalancePartitions" in x)
    assert any("AS base_passenger_fare" in x for x in lines[:at]) and not any("AS base_passenger_fare" in x for x in lines[at:])


def test_month_files_are_compressed_and_hold_the_landing_rows(spark):
    root = scratch_root(spark, "codec")
    fixture.land_months(spark, SF_SMALL, root)
    files = glob.glob(f"{root}/raw/month=*/*.parquet".removeprefix("file:"))
    assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
    trips = fixture.landing_trips(spark, SF_SMALL).withColumnRenamed("landing_month", "month")
    landed = readers.read_months(spark, root).select(*trips.columns)
    assert not landed.exceptAll(trips).take(1) and not trips.exceptAll(landed).take(1)


def test_one_task_writes_more_months_than_it_keeps_open(spark, tmp_path):
    n = sinks.OPEN_MONTHS + 9
    rows = spark.range(0, 50 * n, 1, 1).select("id", F.concat(F.lit("m"), (F.col("id") % n).cast("string")).alias("_source_month"))
    sinks.write_months(rows, str(tmp_path / "t"), cluster=False, months=[f"m{i}" for i in range(n)])
    got = readers.read_table(spark, str(tmp_path / "t"))
    assert sinks.month_rows(got, [f"m{i}" for i in range(n)]) == {f"m{i}": 50 for i in range(n)}
    assert got.select("id").distinct().count() == 50 * n
    assert spark.conf.get(sinks.WRITERS, "0") == "0"  # only inside the write


def test_small_shuffled_sides_are_hashed(spark):
    catalog.Inputs(spark, SF_SMALL)
    assert spark.conf.get(HASH_JOINS) not in ("0", "0b")


def test_month_slice_leaves_other_trips_out_before_it_aggregates(spark):
    got = catalog.q_month_slice_by_date(spark, SF_SMALL)
    assert "1995-03-01 00:00:00" in _plan(got)
    whole = catalog.q_gold_daily_provider(spark, SF_SMALL).where(F.date_format("date", "yyyy-MM") == "1995-03")
    assert not got.exceptAll(whole).take(1) and not whole.exceptAll(got).take(1)


def test_fact_checks_write_only_what_they_read(spark):
    i = catalog.Inputs(spark, SF_SMALL)
    assert {"customer_wait_seconds", "shared_request", "overall_quality_status"}.isdisjoint(catalog._check_silver(i, catalog.FACT_CHECK_MEASURES).columns)


def test_text_landings_are_compressed_and_read_back(spark):
    root = fixture.land_text_months(spark, SF_SMALL, scratch_root(spark, "text_codec"))
    files = [f for m in glob.glob(f"{root}/raw/month=*".removeprefix("file:")) for f in sinks.data_files(spark, m)]
    assert files and all(f.endswith(".txt.lz4") for f in files)
    assert spark.read.text(f"{root}/raw").count() == fixture.landing_trips(spark, SF_SMALL).count()
