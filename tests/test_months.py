"""No month is lost: empty, late, missing and re-issued months; named tables; streams; numbering."""

import pytest
from pyspark.sql import functions as F

from tripmart.config import Settings, Tables
from tripmart.operators import dims
from tripmart.operators.quantiles import exact_quantiles
from tripmart.plans.monthly import MonthRunner, landing_months
from tripmart.session import scratch_root
from tripmart.sources import readers, sinks
from tripmart.sources.fixture import land_months, location_lookup
from tripmart.streaming.landing import default_checkpoint, run_landing_stream

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def landed(spark):
    root = scratch_root(spark, "months_src")
    land_months(spark, SF_SMALL, root)
    lookup = f"{root}/zones"
    location_lookup(spark, SF_SMALL).write.option("header", True).csv(lookup)
    return root, lookup, landing_months(spark, root)


def _land(spark, src, root, months, rows=True):
    raw = readers.read_months(spark, src, months)
    for m in months:
        part = raw.where(F.col("month") == m).drop("month")
        (part if rows else part.limit(0)).write.mode("overwrite").parquet(f"{root}/raw/month={m}")


def test_empty_month_is_retried_when_its_rows_arrive(spark, landed):
    src, lookup, months = landed
    root = scratch_root(spark, "late")
    _land(spark, src, root, months[:1])
    _land(spark, src, root, months[1:2], rows=False)
    t = Tables(root=scratch_root(spark, "late_tables"))
    r = MonthRunner(spark, t, root, lookup_csv=lookup)
    r.bronze(months[:2])
    assert {(x.month, x.status, x.rows > 0) for x in r.results} == {(months[0], "loaded", True), (months[1], "empty", False)}
    _land(spark, src, root, months[1:2])
    again = MonthRunner(spark, t, root, lookup_csv=lookup)
    assert again.bronze(months[:2]) == months[1:2]
    assert sinks.month_rows(again._read("bronze"), months[:2]) == sinks.month_rows(readers.read_months(spark, src, months[:2]), months[:2], "month")


@pytest.mark.parametrize("n", [12, 13])
def test_missing_month_is_an_error_however_many_are_asked_for(spark, landed, n):
    src, lookup, months = landed
    root = scratch_root(spark, "missing")
    _land(spark, src, root, months[: n - 1])
    r = MonthRunner(spark, Tables(root=scratch_root(spark, "missing_tables")), root, lookup_csv=lookup)
    with pytest.raises(readers.MonthsNotLandedError):
        r.bronze(months[:n])
    assert not r._exists("runs")
    assert sorted(r.bronze(months[: n - 1])) == months[: n - 1]


def test_other_months_schema_does_not_matter(spark, landed):
    src, lookup, months = landed
    root = scratch_root(spark, "other")
    _land(spark, src, root, months[:13])
    readers.read_months(spark, src, months[13:14]).drop("month").withColumn("surge_fee", F.lit(1.0)).write.parquet(f"{root}/raw/month={months[13]}")
    r = MonthRunner(spark, Tables(root=scratch_root(spark, "other_tables")), root, lookup_csv=lookup)
    assert len(r.bronze(months[:13])) == 13


def test_replacing_with_an_empty_month_empties_it(spark, landed):
    src, lookup, months = landed
    root = scratch_root(spark, "reissue")
    _land(spark, src, root, months[:2])
    t = Tables(root=scratch_root(spark, "reissue_tables"))
    MonthRunner(spark, t, root, lookup_csv=lookup).run(months[:2])
    _land(spark, src, root, months[:1], rows=False)
    r = MonthRunner(spark, t, root, Settings(load_mode="replace"), lookup_csv=lookup)
    r.run(months[:1])
    for name in ("bronze", "silver", "fact", "gold_partials"):
        assert set(sinks.month_rows(r._read(name), months[:2])) == {months[1]}, name


def test_stage_without_ledger_entry_is_probed(spark, landed):
    """A Silver month that another tool wrote stays as it is, though Bronze already made the ledger."""
    src, lookup, months = landed
    t = Tables(root=scratch_root(spark, "probe"))
    r = MonthRunner(spark, t, src, lookup_csv=lookup)
    r.bronze(months[:1])
    from tripmart.operators.silver import to_silver

    curated = to_silver(r._read("bronze")).limit(3).withColumn("tips", F.lit(99.0))
    sinks.write_months(curated, t.path("silver"))
    assert r.silver(months[:1]) == []
    assert r._read("silver").where("tips = 99").count() == 3


def test_null_provider_is_one_member_on_every_run(spark, landed):
    src, lookup, months = landed
    root = scratch_root(spark, "null_licence")
    raw = readers.read_months(spark, src, months[:1])
    code = F.when(F.col("hvfhs_license_num") != "HV0003", F.col("hvfhs_license_num"))
    raw.withColumn("hvfhs_license_num", code).write.partitionBy("month").parquet(f"{root}/raw")
    t = Tables(root=scratch_root(spark, "null_licence_tables"))
    sizes = []
    for _ in range(3):
        r = MonthRunner(spark, t, root, Settings(load_mode="replace"), lookup_csv=lookup)
        r.bronze(months[:1])
        r.silver(months[:1])
        r.dimensions(months[:1])
        sizes.append(r._read("dim_provider").count())
    assert len(set(sizes)) == 1 and r._read("dim_provider").where("provider_key is null").count() == 1


def test_unreadable_table_is_not_taken_for_absent(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer|read"):
        readers.table_exists(spark, str(tmp_path / "broken"))
    (tmp_path / "empty").mkdir()
    assert not readers.table_exists(spark, str(tmp_path / "empty"))
    assert not readers.table_exists(spark, str(tmp_path / "none"))


def test_a_run_on_named_tables(spark, landed):
    src, lookup, months = landed
    spark.sql("CREATE DATABASE IF NOT EXISTS months_by_name")
    named = MonthRunner(spark, Tables(database="months_by_name"), src, lookup_csv=lookup)
    named.run(months[:2])
    named.run(months[1:3])
    paths = MonthRunner(spark, Tables(root=scratch_root(spark, "by_path")), src, lookup_csv=lookup)
    paths.run(months[:3])
    for name in ("gold_daily_provider", "gold_location", "gold_shared_ride"):
        ours = sorted(map(str, spark.table(f"months_by_name.{name}").collect()))
        assert ours == sorted(map(str, paths._read({"gold_daily_provider": "gold_daily", "gold_shared_ride": "gold_shared"}.get(name, name)).collect()))
    assert spark.table("months_by_name.fact_trip").count() == paths._read("fact").count()
    spark.sql("DROP DATABASE months_by_name CASCADE")


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_numbers_do_not_depend_on_exchange_reuse(spark, reuse):
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        n = 300_000  # more rows than the range sample holds
        df = spark.range(n).select(F.concat(F.lit("b"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("k"), (F.col("id") * 7).alias("more"))
        got = dims.sequence_numbers(df, "k", "number", partitions=16).agg(F.count_distinct("number").alias("d"), F.max("number").alias("m"), F.sum(F.col("more") - 7 * (F.col("number") - 1)).alias("off")).first()
        assert (got.d, got.m, got.off) == (n, n, 0)
        x = spark.range(n).select((F.col("id") * 3 - n).alias("x"))
        assert list(exact_quantiles(x, "x", [0.25, 0.5, 0.75]).first()) == list(x.agg(F.percentile("x", [0.25, 0.5, 0.75])).first()[0])
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)


def test_streams_of_two_roots_do_not_share_state(spark, landed):
    src, lookup, months = landed
    land = scratch_root(spark, "stream_one")
    _land(spark, src, land, months[:1])
    roots = [scratch_root(spark, d) + "/trips" for d in ("prod", "staging")]
    assert len({default_checkpoint(spark, land, Tables(root=r)) for r in roots}) == 2
    for root in roots:
        assert run_landing_stream(spark, land, Tables(root=root), lookup_csv=lookup) == 1
        assert readers.read_table(spark, Tables(root=root).path("fact")).count() > 0


def test_replayed_batch_replaces_its_report(spark, tmp_path):
    report = spark.createDataFrame([("2026-01", "N1", 0), ("2026-01", "N2", 0)], "source_month string, check_id string, batch_id long")
    for _ in range(2):
        sinks.write_months(report, str(tmp_path / "dq_reports"), part_col="batch_id")
    assert readers.read_table(spark, str(tmp_path / "dq_reports")).count() == 2


def test_shared_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    from tripmart.session import shared_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None)))
