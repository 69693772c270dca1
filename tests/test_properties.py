"""Properties and negative cases of the star schema, marts and month runs."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripmart.config import Settings, Tables
from tripmart.operators import dims, marts
from tripmart.operators.lookup import DimensionKeyError, checked
from tripmart.plans.catalog import Inputs
from tripmart.plans.monthly import MonthRunner, landing_months
from tripmart.schemas import SchemaDriftError
from tripmart.session import scratch_root
from tripmart.sources import readers
from tripmart.sources.fixture import land_months, location_lookup

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, SF_SMALL)


def _rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_row_conservation_silver_fact_marts(inputs):
    n = inputs.silver_table.count()
    assert inputs.fact.count() == n
    for mart in (marts.location(inputs.fact, inputs.dim_location), marts.shared_ride(inputs.fact, inputs.dim_provider),
                 marts.daily_provider(marts.partials(inputs.fact, marts.DAILY_GRAIN), inputs.dim_date, inputs.dim_provider)):
        assert mart.agg(F.sum("total_trips")).first()[0] == n


def test_month_partials_rollup_equals_direct(inputs):
    direct = marts.daily_provider(marts.partials(inputs.fact, marts.DAILY_GRAIN), inputs.dim_date, inputs.dim_provider)
    rolled = marts.daily_provider(marts.daily_partials(inputs.fact), inputs.dim_date, inputs.dim_provider)
    assert _rows(direct, ["date_key", "provider_key"]) == _rows(rolled, ["date_key", "provider_key"])


def test_sequence_numbers_equal_global_row_number(spark, inputs):
    members = dims.dispatch_members(inputs.silver_table)
    ours = dims.sequence_numbers(members, "base_num", "k", partitions=3)
    ref = members.withColumn("k", F.row_number().over(Window.orderBy("base_num")).cast("long"))
    assert _rows(ours.select("base_num", "k"), ["base_num"]) == _rows(ref.select("base_num", "k"), ["base_num"])
    ks = [r[0] for r in ours.select("k").orderBy("k").collect()]
    assert ks == list(range(1, len(ks) + 1))


def test_repeated_dimension_key_is_refused(inputs):
    dup = inputs.dim_location.unionByName(inputs.dim_location.limit(1))
    with pytest.raises(DimensionKeyError):
        checked(dup, "location_id", 1000)


def test_calendar_window_and_broken_span(spark):
    window = dims.dim_date_range(spark, "2026-01-30", "2026-02-02").orderBy("date_key").collect()
    assert [(r.date_key, r.is_weekend) for r in window] == [(20260130, False), (20260131, True), (20260201, True), (20260202, False)]
    assert dims.dim_date_range(spark).count() == 151
    span = "timestamp'2026-01-01', timestamp'2026-01-03', timestamp'{}'"
    for last, days in (("2026-01-05", 5), ("9999-12-31", 3), ("0001-01-01", 3)):  # a broken timestamp has no day
        trips = spark.sql(f"SELECT explode(array({span.format(last)})) AS pickup_datetime")
        assert dims.dim_date_for(trips).count() == days
        held = dims.dim_date_range(spark, "2026-01-01", "2026-01-02")
        assert dims.dim_date_extension(trips, held).count() == days - 2
    assert dims.dim_date_for(spark.sql("SELECT timestamp'2026-01-01' AS pickup_datetime").limit(0)).count() == 0


def test_shuffled_lookup_spreads_rows_without_key(spark):
    from tripmart.operators.lookup import lookup

    fact = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN concat('B', id % 7) END AS base")
    dim = spark.createDataFrame([(f"B{i}", i) for i in range(5)], "base_num string, k int")
    got = lookup(fact, dim, "base", "base_num", {"k": "base_key"}, 0, verified=True, spread_nulls=True)
    plain = lookup(fact, dim, "base", "base_num", {"k": "base_key"}, 0, verified=True)
    assert got.columns == plain.columns and _rows(got, ["id"]) == _rows(plain, ["id"])


def test_unknown_provider_maps_to_unknown_name(spark):
    df = spark.createDataFrame([("HV0003",), ("HV0099",)], "hvfhs_license_num string")
    got = dict(dims.dim_provider(df).select("provider_code", "provider_name").collect())
    assert got == {"HV0003": "Uber", "HV0099": "Unknown"}


@pytest.fixture(scope="module")
def landed(spark):
    root = scratch_root(spark, "test_run")
    land_months(spark, SF_SMALL, root)
    lookup = f"{root}/zones"
    location_lookup(spark, SF_SMALL).write.option("header", True).csv(lookup)
    return root, lookup, landing_months(spark, root)


def _snapshot(r):
    out = {}
    for name in ["bronze", "silver", "fact", "dim_dispatch", "dim_provider", "dim_date", "gold_partials"]:
        out[name] = r._read(name).count()
    out["daily"] = _rows(r.gold_daily(), ["date_key", "provider_key"])
    return out


def test_replay_and_month_order_do_not_change_tables(spark, landed):
    root, lookup, months = landed
    a = MonthRunner(spark, Tables(root=scratch_root(spark, "a")), root, lookup_csv=lookup)
    a.run(months)
    first = _snapshot(a)
    a.run(months)  # replay: every stage skips or appends nothing
    assert _snapshot(a) == first
    assert {r.status for r in a.results if r.stage in ("bronze", "silver", "fact")} >= {"skipped"}
    b = MonthRunner(spark, Tables(root=scratch_root(spark, "b")), root, lookup_csv=lookup)
    half = len(months) // 2
    b.run(months[half:])  # later months first
    b.run(months[:half])
    second = _snapshot(b)
    assert second["daily"] == first["daily"]
    assert {k: v for k, v in second.items() if k != "daily"} == {k: v for k, v in first.items() if k != "daily"}


def test_replace_mode_rewrites_only_its_months(spark, landed):
    root, lookup, months = landed
    r = MonthRunner(spark, Tables(root=scratch_root(spark, "replace")), root, Settings(load_mode="replace"),
                    lookup_csv=lookup)
    r.run(months)
    before = r._read("silver").groupBy("_source_month").count().collect()
    r.run(months[:1])
    after = r._read("silver").groupBy("_source_month").count().collect()
    assert sorted(before) == sorted(after)


def test_quality_report_verdicts(spark, landed):
    root, lookup, months = landed
    r = MonthRunner(spark, Tables(root=scratch_root(spark, "dq")), root, lookup_csv=lookup)
    rep = r.run(months)
    rows = rep.collect()
    got = {(x["source_month"], x["check_id"]): x["status"] for x in rows}
    obs = {(x["source_month"], x["check_id"]): x["observed"] for x in rows}
    assert all(got[(m, "N1")] == "PASS" for m in months)
    assert all(got[(m, "N2")] == "PASS" for m in months)
    assert all(got[(m, "N10")] == "PASS" and got[(m, "N11")] == "PASS" for m in months)
    # N5 counts trips whose zone is not in the lookup (ids 25 and 26 are orphans by construction)
    orphans = dict(r._read("silver").where(F.col("PULocationID") > 24).groupBy("_source_month").count().collect())
    for m in months:
        assert obs[(m, "N5")] == orphans.get(m, 0)
        assert got[(m, "N5")] == ("FAIL" if orphans.get(m, 0) else "PASS")
        assert got[(m, "N12")] in ("PASSED", "FAILED")


def test_schema_drift_is_refused(spark, landed):
    root, lookup, months = landed
    bad_root = scratch_root(spark, "drift")
    raw = readers.read_months(spark, root, schema=None)
    raw.drop("cbd_congestion_fee").withColumn("trip_time", F.col("trip_time").cast("double")).write.partitionBy(
        "month").parquet(f"{bad_root}/raw")
    r = MonthRunner(spark, Tables(root=bad_root), bad_root, lookup_csv=lookup)
    with pytest.raises(SchemaDriftError) as e:
        r.bronze(months)
    kinds = {(d[0], d[1]) for d in e.value.diffs}
    assert ("cbd_congestion_fee", "missing") in kinds and ("trip_time", "retyped") in kinds


def test_new_dispatch_bases_are_appended_with_stable_keys(spark, inputs):
    s = inputs.silver_table
    months = sorted(r[0] for r in s.select("_source_month").distinct().collect())
    first = s.where(F.col("_source_month") == months[0])
    path = scratch_root(spark, "disp")
    dims.dim_dispatch(first, "surrogate").write.parquet(path)
    existing = spark.read.parquet(path)
    before = dict(existing.select("base_num", "dispatch_key").collect())
    dims.dispatch_delta(s, existing, "surrogate").write.mode("append").parquet(path)
    after = dict(spark.read.parquet(path).select("base_num", "dispatch_key").collect())
    assert all(after[b] == k for b, k in before.items())
    assert sorted(after.values()) == list(range(1, len(after) + 1))


def test_uncommitted_month_is_rebuilt_not_skipped(spark, landed):
    """A write without a ledger record (e.g. a crash before commit) is redone in skip mode."""
    root, lookup, months = landed
    t = Tables(root=scratch_root(spark, "ledger"))
    r = MonthRunner(spark, t, root, lookup_csv=lookup)
    r.bronze(months[:1])
    # simulate a half-done earlier attempt of the next month: rows present, no ledger record
    raw = readers.read_months(spark, root, months[1:2]).limit(3)
    raw.select(*[c for c in raw.columns if c != "month"], F.col("month").alias("_source_month"),
               F.lit("partial").alias("_source_file"), F.current_timestamp().alias("_ingested_at")).write.mode(
        "append").partitionBy("_source_month").parquet(t.path("bronze"))
    r2 = MonthRunner(spark, t, root, lookup_csv=lookup)
    assert r2._todo("bronze", months[:2]) == months[1:2]
    r2.bronze(months[:2])
    got = r2._read("bronze").where(F.col("_source_month") == months[1]).count()
    assert got == readers.read_months(spark, root, months[1:2]).count()
    assert r2._read("bronze").where(F.col("_source_file") == "partial").count() == 0


def test_drift_in_one_file_of_a_batch_is_caught(spark, landed):
    """One month landed with an extra column and another retyped: both caught before any row is read."""
    root, lookup, months = landed
    mixed = scratch_root(spark, "mixed")
    raw = readers.read_months(spark, root, months[:3])
    raw.where(F.col("month") == months[0]).write.partitionBy("month").parquet(f"{mixed}/raw")
    raw.where(F.col("month") == months[1]).withColumn("surge_fee", F.lit(1.0)).write.mode("append").partitionBy(
        "month").parquet(f"{mixed}/raw")
    r = MonthRunner(spark, Tables(root=mixed), mixed, lookup_csv=lookup)
    with pytest.raises(SchemaDriftError) as e:
        r.bronze(months[:2])
    assert ("surge_fee", "new") in {(d[0], d[1]) for d in e.value.diffs}
    raw.where(F.col("month") == months[2]).withColumn("trip_time", F.col("trip_time").cast("string")).write.mode(
        "append").partitionBy("month").parquet(f"{mixed}/raw")
    with pytest.raises(SchemaDriftError):
        MonthRunner(spark, Tables(root=mixed), mixed, lookup_csv=lookup).bronze([months[0], months[2]])


def test_table_format_is_a_parameter(spark, landed):
    """The same run on ORC tables gives the same marts as on Parquet."""
    root, lookup, months = landed
    few = months[:6]
    pq = MonthRunner(spark, Tables(root=scratch_root(spark, "fmt_pq")), root, lookup_csv=lookup)
    orc = MonthRunner(spark, Tables(root=scratch_root(spark, "fmt_orc"), fmt="orc"), root, lookup_csv=lookup)
    pq.run(few)
    orc.run(few)
    assert _rows(orc.gold_daily(), ["date_key", "provider_key"]) == _rows(pq.gold_daily(), ["date_key", "provider_key"])
    assert _rows(orc.gold_shared(), ["provider_key"]) == _rows(pq.gold_shared(), ["provider_key"])
    assert spark.read.orc(orc.t.path("fact")).count() == pq._read("fact").count()


def test_empty_month_fails_n1_without_crashing(spark, landed):
    """A landed month with no rows: every stage runs, the report FAILs N1 for it (X10: no crash on empty marts)."""
    root, lookup, months = landed
    raw = readers.read_months(spark, root, months[:1])
    empty_root = scratch_root(spark, "empty")
    raw.where(F.col("month") == months[0]).write.partitionBy("month").parquet(f"{empty_root}/raw")
    raw.drop("month").limit(0).write.parquet(f"{empty_root}/raw/month=2099-01")
    r = MonthRunner(spark, Tables(root=scratch_root(spark, "empty_tables")), empty_root, lookup_csv=lookup)
    rep = {(x["source_month"], x["check_id"]): x["status"] for x in r.run([months[0], "2099-01"]).collect()}
    assert rep[("2099-01", "N1")] == "FAIL"
    assert rep[("2099-01", "N12")] == "FAILED"
    assert rep[(months[0], "N1")] == "PASS"


def test_exact_quantiles_match_percentile(spark):
    """Distributed exact quartiles equal Spark's single-buffer percentile on generated data (NULLs included)."""
    import random

    from tripmart.operators.quantiles import exact_quantiles

    rnd = random.Random(7)
    for _ in range(3):
        vals = [rnd.randint(-40, 40) for _ in range(rnd.randint(1, 300))] + [None]
        df = spark.createDataFrame([(v,) for v in vals], "x long")
        got = list(exact_quantiles(df, "x", [0.25, 0.5, 0.75]).first())
        ref = df.agg(F.percentile("x", [0.25, 0.5, 0.75])).first()[0]
        assert got == ref


def test_summary_of_empty_input_has_all_rows(spark):
    from tripmart.operators.profile import _stats_rows

    df = spark.createDataFrame([(None,)], "x long")
    rows = {r["statistic"]: r["x"] for r in _stats_rows(df, ["x"]).collect()}
    assert rows["count"] == 0.0 and rows["50%"] is None and len(rows) == 8


def test_wide_trip_key_keeps_duplicate_semantics(spark, inputs):
    """With the 128-bit identity the duplicate check still finds real copies, and only them."""
    from tripmart.operators.fact import build_fact
    from tripmart.operators.quality import fact_month_metrics
    from tripmart.schemas import TRIP_KEY_COLUMNS

    s = Settings(wide_trip_key=True)
    fact = build_fact(inputs.silver_table, inputs.dim_provider, inputs.dim_location, inputs.dim_dispatch, s)
    assert "trip_key_ext" in fact.columns
    assert fact.where(F.col("trip_key") == F.col("trip_key_ext")).count() == 0
    single = fact_month_metrics(fact).agg(F.sum("duplicate_trip_keys")).first()[0]
    doubled = build_fact(inputs.silver_table.unionByName(inputs.silver_table), inputs.dim_provider,
                         inputs.dim_location, inputs.dim_dispatch, s)
    dup = fact_month_metrics(doubled).agg(F.sum("duplicate_trip_keys")).first()[0]
    natural = inputs.silver_table.select("_source_month", *TRIP_KEY_COLUMNS).distinct().count()
    assert single == 0 and dup == natural


def test_ledger_compaction_keeps_rows_and_skips(spark, landed):
    import os

    root, lookup, months = landed
    t = Tables(root=scratch_root(spark, "compact"))
    r = MonthRunner(spark, t, root, lookup_csv=lookup)
    r.run(months[:2])
    r.run(months[2:4])
    before = sorted(tuple(x) for x in r._read("runs").select("month", "stage", "status").collect())
    files = lambda: len([f for f in os.listdir(t.path("runs").replace("file:", "")) if f.endswith(".parquet")])
    assert files() > 1
    assert r.compact_ledger() == len(before)
    assert files() == 1
    assert sorted(tuple(x) for x in r._read("runs").select("month", "stage", "status").collect()) == before
    r2 = MonthRunner(spark, t, root, lookup_csv=lookup)
    assert r2._todo("silver", months[:4]) == []
