"""Trip identity behind repeated keys, key values against another XXH64, and mergeable quantile sketches."""

import datetime as dt
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from tripmart.config import Tables
from tripmart.operators import identity, sketches
from tripmart.operators.fact import trip_key
from tripmart.operators.silver import to_silver
from tripmart.plans.monthly import MonthRunner, landing_months
from tripmart.schemas import TRIP_KEY_COLUMNS, TRIP_SOURCE
from tripmart.session import scratch_root
from tripmart.sources import readers, sinks
from tripmart.sources.fixture import bronze_view, land_months, location_lookup

from .conftest import SF_SMALL

TYPES = {f.name: f.dataType for f in TRIP_SOURCE.fields}
DDL = ", ".join(f"{c} {TYPES[c].simpleString()}" for c in TRIP_KEY_COLUMNS)
T0 = dt.datetime(2026, 1, 1, 8)


def _trip(pu=1, do=2, miles=1.0, pay=8.0):
    return ("HV0003", T0, T0, T0, pu, do, miles, 60, 10.0, pay)


def _keyed(spark, rows):
    return spark.createDataFrame(rows, DDL).withColumn("trip_key", trip_key())


def _bytes(name, v):
    kind = TYPES[name].simpleString()
    if kind == "string":
        return v.encode()
    if kind == "int":
        return struct.pack("<i", v)
    if kind == "bigint":
        return struct.pack("<q", v)
    if kind == "double":
        return struct.pack("<d", v + 0.0)
    return struct.pack("<q", (v - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1))


def _key_of(row):
    """The same chain of hashes with another library: every value is hashed with the hash so far as seed, NULLs are skipped."""
    h = 42
    for c in TRIP_KEY_COLUMNS:
        if row[c] is not None:
            h = xxhash.xxh64_intdigest(_bytes(c, row[c]), seed=h)
    return h - (1 << 64) if h >= 1 << 63 else h


def test_key_values_of_all_trips(spark):
    rows = to_silver(bronze_view(spark, SF_SMALL)).select(*TRIP_KEY_COLUMNS, trip_key().alias("k")).collect()
    assert len(rows) > 5000 and all(r["k"] == _key_of(r) for r in rows)


def test_key_values_with_nulls(spark):
    rows = _keyed(spark, [_trip(), _trip(None, None), (None,) * 10, _trip(miles=None, pay=-0.5)]).collect()
    assert [r["trip_key"] for r in rows] == [_key_of(r) for r in rows]


def test_duplicates_and_collisions(spark):
    once, twice = _trip(9, 9), _trip(1, 2)
    there, other = _trip(5, None), _trip(None, 5)  # hash alike
    more, more_other = _trip(6, None), _trip(None, 6)
    df = _keyed(spark, [once, twice, twice, there, other, more, more, more_other])
    got = {(r["verdict"], r["trips"], r["key_rows"]) for r in identity.verdicts(df).collect()}
    assert got == {("duplicate", 1, 2), ("collision", 2, 2), ("both", 2, 3)}
    rep = {r["verdict"]: (r["key_count"], r["trip_count"], r["row_count"], r["surplus_rows"]) for r in identity.report(df).collect()}
    assert rep == {"duplicate": (1, 1, 2, 1), "collision": (1, 2, 2, 0), "both": (1, 2, 3, 1)}


def test_null_keys_are_compared_and_no_rows_give_no_verdicts(spark):
    nothing = (None,) * 10
    assert [r["verdict"] for r in identity.verdicts(_keyed(spark, [nothing, nothing])).collect()] == ["duplicate"]
    assert identity.report(_keyed(spark, [])).count() == 0
    assert identity.report(_keyed(spark, [_trip(i) for i in range(50)])).count() == 0


def test_a_hot_key_is_one_verdict(spark):
    df = _keyed(spark, [_trip()] * 4000 + [_trip(i, i) for i in range(10, 2000)])
    assert [tuple(r) for r in identity.report(df).collect()] == [("duplicate", 1, 1, 4000, 3999)]


def test_only_rows_of_repeated_keys_are_shuffled_whole(spark):
    plan = identity.identities(_keyed(spark, [_trip()]))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


# -- sketches -------------------------------------------------------------------

def _ranks_ok(values, found, k):
    v = sorted(values)
    n, e = len(v), sketches.rank_error(k)
    for p, x in found:
        below, upto = sum(a < x for a in v) / n, sum(a <= x for a in v) / n
        assert below - e <= p <= upto + e, (p, x, below, upto)


@pytest.mark.parametrize("k", [100, 400])
def test_merged_months_stay_within_the_bound(spark, k):
    trips = to_silver(bronze_view(spark, SF_SMALL)).select(*sketches.MEASURES, "_source_month").cache()
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]
    by_month = sketches.month_sketches(trips, k=k)
    got = sketches.quantiles(sketches.merged(by_month), probs).collect()
    for m in sketches.MEASURES:
        values = [float(r[0]) for r in trips.where(F.col(m).isNotNull()).select(m).collect()]
        own = [r for r in got if r["measure"] == m]
        assert {r["value_count"] for r in own} == {len(values)} and len(own) == len(probs)
        _ranks_ok(values, [(r["probability"], r["value"]) for r in own], k)
        assert min(values) == next(r["value"] for r in own if r["probability"] == 0.0)
        assert max(values) == next(r["value"] for r in own if r["probability"] == 1.0)


def test_a_replaced_month_replaces_only_its_sketches(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(1000)] + [("b", 5000.0 + i) for i in range(1000)], "_source_month string, x double")
    held = sketches.month_sketches(df, ["x"]).where("_source_month = 'a'")
    again = sketches.month_sketches(spark.createDataFrame([("b", float(i)) for i in range(1000)], df.schema), ["x"])
    found = sketches.quantiles(sketches.merged(held.unionByName(again)), [0.5, 1.0]).collect()
    assert {r["value_count"] for r in found} == {2000} and max(r["value"] for r in found) == 999.0


def test_nulls_nan_and_empty_inputs(spark):
    df = spark.createDataFrame([("a", None), ("a", float("nan")), ("a", 3.0), ("b", None)], "_source_month string, x double")
    found = sketches.quantiles(sketches.merged(sketches.month_sketches(df, ["x"])), [0.5]).collect()
    assert [(r["value_count"], r["value"]) for r in found] == [(1, 3.0)]
    for none in (df.where("false"), df.where("_source_month = 'b'")):
        assert sketches.quantiles(sketches.merged(sketches.month_sketches(none, ["x"])), [0.5]).count() == 0


def test_month_runs_keep_sketches_and_tell_repeated_trips(spark):
    """Only months that are new or re-issued are sketched again; a month loaded with every trip twice is told from collisions."""
    root = scratch_root(spark, "sketch_run")
    land_months(spark, SF_SMALL, root)
    a, b = landing_months(spark, root)[:2]
    t = Tables(root=root)
    first = MonthRunner(spark, t, root)
    first.silver(first.bronze([a, b]))
    assert first.month_sketches([a, b]) == [a, b]
    rows = first._read("silver").where(F.col("trip_miles").isNotNull()).count()
    assert {r["value_count"] for r in first.quantiles([0.5]).where("measure = 'trip_miles'").collect()} == {rows}
    assert first.repeated_trips([a, b]).count() == 0
    landed = readers.read_months(spark, root, [b]).drop("month").checkpoint(eager=True)
    sinks.relay(landed.unionByName(landed), f"{root}/raw/month={b}")
    again = MonthRunner(spark, t, root)
    again.bronze([a, b])
    again.silver([a, b])
    assert again.month_sketches([a, b]) == [b]
    n = landed.count()
    assert {r["value_count"] for r in again.quantiles([0.5]).where("measure = 'trip_miles'").collect()} == {rows + n}
    assert {r["value_count"] for r in again.quantiles([0.5], [a]).where("measure = 'trip_miles'").collect()} == {rows - n}
    assert [(r["verdict"], r["row_count"], r["surplus_rows"]) for r in again.repeated_trips([a, b]).collect()] == [("duplicate", 2 * n, n)]


def test_a_broken_timestamp_is_flagged_not_fatal(spark):
    root = scratch_root(spark, "broken_time")
    land_months(spark, SF_SMALL, root)
    a = landing_months(spark, root)[0]
    folder = f"{root}/raw/month={a}"
    landed = readers.read_months(spark, root, [a]).drop("month").checkpoint(eager=True)
    zone = landed.agg(F.min("PULocationID")).first()[0]
    far = F.when(F.col("PULocationID") == zone, F.lit(dt.datetime(9999, 1, 1)).cast("timestamp_ntz")).otherwise(F.col("pickup_datetime"))
    sinks.relay(landed.withColumn("pickup_datetime", far), folder)
    lookup = f"{root}/zones"
    location_lookup(spark, SF_SMALL).write.option("header", True).csv(lookup)
    r = MonthRunner(spark, Tables(root=root), root, lookup_csv=lookup)
    r.run([a])
    broken = landed.where(F.col("PULocationID") == zone).count()
    fact = r._read("fact")
    assert broken > 0 and fact.count() == landed.count()
    assert fact.where("date_key IS NULL").count() == broken
    assert fact.where("date_key IS NULL AND timestamp_quality_flag = 'OK'").count() == 0
    assert r._read("dim_date").agg(F.max("year")).first()[0] < 2000
    assert r.gold_daily().where("date_key IS NULL").agg(F.sum("total_trips")).first()[0] == broken
