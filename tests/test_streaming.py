"""The landing stream reaches the same marts as the batch runner, also when months land in two waves."""

from pyspark.sql import functions as F

from tripmart.config import Tables
from tripmart.plans.monthly import MonthRunner, landing_months
from tripmart.session import scratch_root
from tripmart.sources import readers
from tripmart.sources.fixture import land_months, location_lookup
from tripmart.streaming.landing import run_landing_stream

from .conftest import SF_SMALL


def test_stream_in_two_waves_equals_batch(spark):
    src = scratch_root(spark, "stream_src")
    land_months(spark, SF_SMALL, src)
    months = landing_months(spark, src)
    lookup = f"{src}/zones"
    location_lookup(spark, SF_SMALL).write.option("header", True).csv(lookup)

    # batch reference
    batch = MonthRunner(spark, Tables(root=scratch_root(spark, "stream_batch")), src, lookup_csv=lookup)
    batch.run(months)
    expected = sorted(tuple(r) for r in batch.gold_daily().collect())

    # the stream sees the landing folder fill in two waves
    land = scratch_root(spark, "stream_land")
    raw = readers.read_months(spark, src)
    half = months[len(months) // 2]
    raw.where(F.col("month") < half).write.partitionBy("month").parquet(f"{land}/raw")
    tables = Tables(root=scratch_root(spark, "stream_tables"))
    ckpt = scratch_root(spark, "stream_ckpt")
    assert run_landing_stream(spark, land, tables, lookup_csv=lookup, checkpoint=ckpt) >= 1
    raw.where(F.col("month") >= half).write.mode("append").partitionBy("month").parquet(f"{land}/raw")
    assert run_landing_stream(spark, land, tables, lookup_csv=lookup, checkpoint=ckpt) >= 1
    assert run_landing_stream(spark, land, tables, lookup_csv=lookup, checkpoint=ckpt) == 0  # nothing new

    streamed = MonthRunner(spark, tables, land, lookup_csv=lookup)
    got = sorted(tuple(r) for r in streamed.gold_daily().collect())
    assert got == expected
    assert streamed._read("fact").count() == batch._read("fact").count()
