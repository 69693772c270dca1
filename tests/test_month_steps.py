"""Steps of the month runs that cost CPU per trip: same results as the plain expressions, without their cost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.calendar import calendar_date, date_key
from tripmart.functions.rules import decimal_sum
from tripmart.operators import marts
from tripmart.operators.fact import trip_key
from tripmart.schemas import TRIP_KEY_COLUMNS, TRIP_SOURCE
from tripmart.sources import fixture, sinks

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("wide, values", [
    (T.LongType(), [0, -1, 2**31 - 1, 2**31, -(2**31), -(2**31) - 1, 2**40 + 26, None]),
    (T.DoubleType(), [0.0, -0.0, 1.5, 2147483647.0, 2147483647.5, 2147483648.0, -2147483648.0, -2147483648.5, float("nan"), float("inf"), None]),
])
def test_widened_ids_are_hashed_without_failing_casts(spark, wide, values):
    rows = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("PULocationID", wide)]))
    rest = {c: F.lit(None).cast(TRIP_SOURCE[c].dataType) for c in TRIP_KEY_COLUMNS if c != "PULocationID"}
    rows = rows.withColumns(rest)
    got = trip_key({"PULocationID": wide})
    tried = F.col("PULocationID").try_cast("int")
    fits = F.coalesce(tried.cast(wide) == F.col("PULocationID"), F.lit(False))
    want = F.xxhash64(*[x for c in TRIP_KEY_COLUMNS for x in ([F.when(fits, tried), F.when(~fits, F.col(c))] if c == "PULocationID" else [F.col(c)])])
    assert rows.where(~got.eqNullSafe(want)).count() == 0
    plan = _plan(rows.select(got)).lower()
    assert "try_cast" not in plan and "tryeval" not in plan


def test_decimal_sums_round_every_value_as_the_cast_does(spark):
    odd = [0.1, 0.2, 0.00005, 0.00015, -0.00005, 0.00004999999, 1.00005, 2.5, -3.25, 214748.3647, 214748.3648, 214748.36485, -214748.3648, 1e9, -1e9,
           123456789.12345, 99999999999.99995, 1e-300, 0.0, -0.0, 0.30000000000000004, 1.1 + 2.2, 4.35, 1.005, None]
    values = [(f"v{i}", v) for i, v in enumerate(odd)] + [("all", v) for v in odd] + [("none", None), ("none", None)]
    rows = spark.createDataFrame(values, "k string, x double")
    cast = F.sum(F.col("x").cast("decimal(18,4)")).cast("decimal(28,4)")
    got = rows.groupBy("k").agg(decimal_sum("x").alias("got"), cast.alias("want"))
    assert got.where(~F.col("got").eqNullSafe(F.col("want"))).collect() == [] and got.count() == len(odd) + 2
    assert got.schema["got"].dataType == T.DecimalType(28, 4)
    drawn = spark.range(200_000).select((F.col("id") % 50).alias("k"), ((F.rand(7) - 0.5) * F.pow(F.lit(10.0), F.col("id") % 9)).alias("x"))
    both = drawn.groupBy("k").agg(decimal_sum("x").alias("got"), cast.alias("want"))
    assert both.where(~F.col("got").eqNullSafe(F.col("want"))).collect() == []
    assert spark.range(0).select(F.lit(1.5).alias("x")).agg(decimal_sum("x").alias("s")).first()["s"] is None


def test_mart_partials_add_money_as_integers(spark):
    sums = [str(c._jc) for c in marts.trip_partials() if "fare_sum" in str(c._jc)]
    assert sums and "rint" in sums[0].lower()


def test_date_keys_are_computed_not_formatted(spark):
    days = [dt.datetime(1900, 1, 1), dt.datetime(1899, 12, 31, 23, 59, 59), dt.datetime(2099, 12, 31, 23, 59, 59), dt.datetime(2100, 1, 1), dt.datetime(2024, 2, 29, 12), dt.datetime(1995, 10, 9, 0, 0, 1), None]
    rows = spark.createDataFrame([(d,) for d in days], T.StructType([T.StructField("pickup_datetime", T.TimestampNTZType())]))
    want = F.date_format(calendar_date("pickup_datetime"), "yyyyMMdd").cast("int")
    keyed = rows.select(date_key("pickup_datetime").alias("k"), want.alias("w"))
    assert keyed.where(~F.col("k").eqNullSafe(F.col("w"))).count() == 0 and keyed.schema["k"].dataType == T.IntegerType()
    assert "date_format" not in _plan(rows.select(date_key("pickup_datetime"))).lower()


def test_the_landing_month_is_formatted_per_order(spark):
    lines = _plan(fixture._by_month(spark, SF_SMALL)).splitlines()
    join = next(i for i, x in enumerate(lines) if "Join Inner" in x)
    assert [i > join for i, x in enumerate(lines) if "date_format(" in x] == [True]


def test_month_writes_split_their_scans_finer_than_the_cores(spark, tmp_path):
    files = 6 * spark.sparkContext.defaultParallelism
    spark.range(0, 100 * files, 1, files).write.parquet(str(tmp_path / "t"))
    with sinks.unsorted_months(spark):
        inside = spark.read.parquet(str(tmp_path / "t")).rdd.getNumPartitions()
    outside = spark.read.parquet(str(tmp_path / "t")).rdd.getNumPartitions()
    assert inside > outside and spark.conf.get(sinks.SPLITS, None) is None
    spark.conf.set(sinks.SPLITS, "2")
    try:
        with sinks.unsorted_months(spark):
            assert spark.conf.get(sinks.SPLITS) == "2"
    finally:
        spark.conf.unset(sinks.SPLITS)
