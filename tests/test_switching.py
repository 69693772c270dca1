"""All-or-nothing runs: a crash after any step leaves the old state readable in every table."""

import pytest
from pyspark.sql import functions as F

from tripmart.config import Settings, Tables
from tripmart.plans.monthly import MonthRunner
from tripmart.plans.switching import MARTS, MONTH_TABLES, ChecksFailed, SwitchedRunner
from tripmart.session import scratch_root
from tripmart.sources import readers, sinks
from tripmart.sources.fixture import land_months, location_lookup

from .conftest import SF_SMALL

MONTHS = ["1995-01", "1995-02", "1995-03"]


@pytest.fixture(scope="module")
def landing(spark):
    root = scratch_root(spark, "switch_src")
    land_months(spark, SF_SMALL, root, MONTHS)
    lookup = f"{root}/zones"
    location_lookup(spark, SF_SMALL).write.option("header", True).csv(lookup)
    return root, lookup


@pytest.fixture
def database(spark, request):
    name = f"switch_{abs(hash(request.node.name)) % 10**8}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def _seen(spark, t):
    """What readers see: every table's rows without run-dependent columns."""
    out = {}
    for name in (*MONTH_TABLES, *MARTS):
        rows = spark.table(t.path(name)).drop("_source_file", "_ingested_at")
        out[name] = sorted(map(str, rows.select(*sorted(rows.columns)).collect()))
    return out


def _reissue(spark, src, label):
    """A landing where the first month has lost its low zones and the second all its rows."""
    root = scratch_root(spark, label)
    raw = readers.read_months(spark, src, MONTHS)
    raw.where((F.col("month") == MONTHS[2]) | ((F.col("month") == MONTHS[0]) & (F.col("PULocationID") >= 9))).write.partitionBy("month").parquet(f"{root}/raw")
    raw.where("false").drop("month").write.parquet(f"{root}/raw/month={MONTHS[1]}")
    return root


def test_switched_runs_equal_plain_ones(spark, landing, database):
    src, lookup = landing
    t = Tables(database=database)
    SwitchedRunner(spark, t, src, lookup_csv=lookup).run(MONTHS[:2])
    report = SwitchedRunner(spark, t, src, lookup_csv=lookup).run(MONTHS)
    plain = MonthRunner(spark, Tables(root=scratch_root(spark, "plain")), src, lookup_csv=lookup)
    want = plain.run(MONTHS)
    assert sorted(map(str, report.collect())) == sorted(map(str, want.collect()))
    for name, rows in _seen(spark, t).items():
        theirs = plain._read(name).drop("_source_file", "_ingested_at")
        assert rows == sorted(map(str, theirs.select(*sorted(theirs.columns)).collect())), name


@pytest.mark.parametrize("step", ["bronze", "silver", "dimensions", "fact", "mart_partials", "publish", "checks", "switch"])
def test_a_crash_after_any_step_leaves_the_old_state(spark, landing, database, monkeypatch, step):
    src, lookup = landing
    t = Tables(database=database)
    SwitchedRunner(spark, t, src, lookup_csv=lookup).run(MONTHS)
    before = _seen(spark, t)
    changed = _reissue(spark, src, "switch_reissue")
    broken = SwitchedRunner(spark, t, changed, Settings(load_mode="replace"), lookup_csv=lookup)
    done = getattr(broken, step)

    def dies(*args, **kwargs):
        if step != "switch":  # before the one replaced view
            done(*args, **kwargs)
        raise ConnectionError("lost")

    monkeypatch.setattr(broken, step, dies)
    with pytest.raises(ConnectionError):
        broken.run(MONTHS)
    assert _seen(spark, t) == before
    if step in ("fact", "switch"):  # the next run takes the new state in whole, whatever was left behind
        after = SwitchedRunner(spark, t, changed, lookup_csv=lookup)
        after.run(MONTHS)
        assert set(sinks.month_rows(spark.table(t.path("fact")), MONTHS)) == {MONTHS[0], MONTHS[2]}
        now = _seen(spark, t)
        assert after.vacuum() > 0 and after.vacuum() == 0 and _seen(spark, t) == now


def test_failed_checks_switch_nothing(spark, landing, database, monkeypatch):
    src, lookup = landing
    t = Tables(database=database)
    SwitchedRunner(spark, t, src, lookup_csv=lookup).run(MONTHS[:1])
    before = _seen(spark, t)
    strict = SwitchedRunner(spark, t, src, lookup_csv=lookup, must_pass=("N2", "N5"))  # this fixture has unknown zones
    with pytest.raises(ChecksFailed, match="N5"):
        strict.run(MONTHS)
    assert _seen(spark, t) == before


def test_names_are_needed(spark):
    with pytest.raises(ValueError, match="named tables"):
        SwitchedRunner(spark, Tables(root="/nowhere"), "/nowhere")
