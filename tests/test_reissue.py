"""Changed landings, late members, control totals and the spill diagnostic."""

import pytest
from pyspark.sql import functions as F

from tripmart.config import Settings, Tables
from tripmart.operators import quality
from tripmart.plans.monthly import MonthRunner, landing_months
from tripmart.session import scratch_root
from tripmart.sources import readers, sinks
from tripmart.sources.fixture import land_months, location_lookup

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def landed(spark):
    root = scratch_root(spark, "reissue_src")
    land_months(spark, SF_SMALL, root)
    lookup = f"{root}/zones"
    location_lookup(spark, SF_SMALL).write.option("header", True).csv(lookup)
    return root, lookup, landing_months(spark, root)


def _copy(spark, src, months, label):
    root = scratch_root(spark, label)
    readers.read_months(spark, src, months).write.partitionBy("month").parquet(f"{root}/raw")
    return root


def _did(r, stage):
    return {x.month: x.status for x in r.results if x.stage == stage}


def test_changed_landings_reload_just_their_months(spark, landed):
    src, lookup, months = landed
    months = months[:5]
    root = _copy(spark, src, months, "changed")
    two = readers.read_months(spark, src, months[2:3]).drop("month")
    sinks.relay(two.where("PULocationID < 13"), f"{root}/raw/month={months[2]}")
    first_files = set(sinks.data_files(spark, f"{root}/raw/month={months[2]}"))
    two.where("PULocationID >= 13").write.mode("append").parquet(f"{root}/raw/month={months[2]}")
    t = Tables(root=scratch_root(spark, "changed_tables"))
    MonthRunner(spark, t, root, lookup_csv=lookup).run(months)
    rows = readers.read_months(spark, src, months)
    sinks.relay(rows.where((F.col("month") == months[0]) & (F.col("PULocationID") >= 5)).drop("month"), f"{root}/raw/month={months[0]}")  # re-issued
    rows.where(F.col("month") == months[1]).limit(7).drop("month").write.mode("append").parquet(f"{root}/raw/month={months[1]}")  # a file more
    sinks.remove_files(spark, first_files)  # a file less
    again = MonthRunner(spark, t, root, lookup_csv=lookup)
    assert again.changed_landings(months) == months[:3]
    again.run(months)
    for stage in ("bronze", "silver", "fact", "gold_partials"):
        assert _did(again, stage) == {m: "loaded" if m in months[:3] else "skipped" for m in months}, stage
    want = sinks.month_rows(readers.read_months(spark, root, months), months, "month")
    for name in ("bronze", "silver", "fact"):
        assert sinks.month_rows(again._read(name), months) == want
    assert again.gold_daily().agg(F.sum("total_trips")).first()[0] == sum(want.values())
    third = MonthRunner(spark, t, root, lookup_csv=lookup)
    third.run(months)
    assert set(_did(third, "fact").values()) == {"skipped"}


def test_a_month_rebuilt_by_hand_is_carried_on(spark, landed):
    src, lookup, months = landed
    t = Tables(root=scratch_root(spark, "carried"))
    MonthRunner(spark, t, src, lookup_csv=lookup).run(months[:2])
    MonthRunner(spark, t, src, Settings(load_mode="replace"), lookup_csv=lookup).silver(months[:1])
    r = MonthRunner(spark, t, src, lookup_csv=lookup)
    r.run(months[:2])
    assert _did(r, "bronze") == {m: "skipped" for m in months[:2]}
    assert _did(r, "fact") == {months[0]: "loaded", months[1]: "skipped"} == _did(r, "gold_partials")


def test_counts_are_taken_while_writing(spark, tmp_path):
    rows = spark.range(1000).select("id", F.concat(F.lit("m"), F.col("id") % 7).alias("_source_month"), (F.col("id") % 3).alias("left"))
    got = sinks.write_months(rows, str(tmp_path / "t"), months=[f"m{i}" for i in range(9)], unresolved="left")
    want = {f"m{r[0]}": (r[1], r[2]) for r in rows.groupBy(F.col("id") % 7).agg(F.count("*"), F.sum("left")).collect()}
    assert got == want | {"m7": (0, 0), "m8": (0, 0)}
    assert spark.read.parquet(str(tmp_path / "t")).columns == ["id", "_source_month"]


def test_late_members_rewrite_just_the_months_that_resolve(spark, landed):
    src, lookup, months = landed
    months = months[:4]
    t, few = Tables(root=scratch_root(spark, "late_tables")), scratch_root(spark, "few_zones")
    zones = readers.read_lookup_csv(spark, lookup)
    zones.where("LocationID < 20").write.option("header", True).csv(few)
    # a month without any trip of the late zones
    root = scratch_root(spark, "late_src")
    raw = readers.read_months(spark, src, months).where((F.col("month") != months[1]) | ((F.col("PULocationID") < 20) & (F.col("DOLocationID") < 20)))
    raw.write.partitionBy("month").parquet(f"{root}/raw")
    r = MonthRunner(spark, t, root, lookup_csv=few)
    r.run(months)
    assert MonthRunner(spark, t, root, lookup_csv=few).late_months() == []
    late = MonthRunner(spark, t, root, lookup_csv=lookup)
    late.dimensions(months)
    assert late._read("dim_location").count() == zones.count()
    assert late.late_months() == [m for m in months if m != months[1]]
    newest = MonthRunner(spark, t, root, lookup_csv=lookup)
    newest.run(months[3:])  # the months before are not asked for, and resolved all the same
    paths = MonthRunner(spark, Tables(root=scratch_root(spark, "at_once")), root, lookup_csv=lookup)
    paths.run(months)
    keys = ["_source_month", "trip_key", "provider_key", "pickup_location_key", "dropoff_location_key", "dispatching_base_key", "originating_base_key"]
    assert sorted(map(str, newest._read("fact").select(*keys).collect())) == sorted(map(str, paths._read("fact").select(*keys).collect()))
    assert sorted(map(str, newest._read("gold_location").collect())) == sorted(map(str, paths._read("gold_location").collect()))
    assert newest.late_months() == []


def test_control_totals_are_the_ledgers(spark, landed):
    src, lookup, months = landed
    t = Tables(root=scratch_root(spark, "totals"))
    r = MonthRunner(spark, t, src, lookup_csv=lookup)
    r.run(months[:3])
    other = readers.read_table(spark, t.path("fact")).where(F.col("_source_month") == months[0]).limit(5).withColumn("_source_month", F.lit("2030-01"))
    sinks.write_months(other.checkpoint(), t.path("fact"))  # by another tool
    again = MonthRunner(spark, t, src, lookup_csv=lookup)
    assert again.total_rows("fact") == again._read("fact").count()


def test_spill_explains_the_daily_check(spark, landed):
    src, lookup, months = landed
    root = scratch_root(spark, "spill")
    month = F.col("month")
    shifted = F.when(F.col("PULocationID") < 3, F.col("pickup_datetime") + F.expr("INTERVAL 31 DAYS")).when(F.col("PULocationID") != 7, F.col("pickup_datetime"))
    readers.read_months(spark, src, months[:3]).withColumn("pickup_datetime", shifted).write.partitionBy("month").parquet(f"{root}/raw")
    r = MonthRunner(spark, Tables(root=scratch_root(spark, "spill_tables")), root, lookup_csv=lookup)
    report = {x.source_month: x.observed - x.expected for x in r.run(months[:3]).where("check_id = 'N9'").collect()}
    spilled = r.spill()
    per_month = {x.source_month: x for x in quality.spill_per_month(spilled).collect()}
    assert {m: x.spill_rows for m, x in per_month.items()} == report
    raw = readers.read_months(spark, root, months[:3])
    want = raw.where(~F.date_format("pickup_datetime", "yyyy-MM").eqNullSafe(month)).groupBy(month, F.to_date("pickup_datetime").alias("d")).count().collect()
    assert {(x.source_month, x.date): x.trips for x in spilled.where("direction = 'out'").collect()} == {(x.month, x.d): x["count"] for x in want}
    assert any(x.date is None for x in spilled.collect()) and any(x.spill_in for x in per_month.values())
