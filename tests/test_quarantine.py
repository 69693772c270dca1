"""Broken rows of text landings: reasons, headers, re-issues, and nothing lost between Bronze and the quarantine."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.config import Settings, Tables
from tripmart.plans.monthly import MonthRunner
from tripmart.plans.switching import SwitchedRunner
from tripmart.schemas import TRIP_SOURCE
from tripmart.session import scratch_root
from tripmart.sources import quarantine, readers

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("at", T.TimestampNTZType()), T.StructField("name", T.StringType()),
                       T.StructField("fare", T.DoubleType())])
GOOD = "1,2026-01-02T03:04:05,a,1.5"


def _file(folder, lines, name="part.csv"):
    folder = folder.removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("".join(x + "\n" for x in lines))
    return folder


def _reasons(spark, lines, required=(), label="kept"):
    path = _file(scratch_root(spark, label), lines)
    rows = quarantine.screened(quarantine.read_kept(spark, path, SCHEMA, header=False).withColumn("_source_file", F.col("_metadata.file_path")).withColumn("month", F.lit("m")), SCHEMA, required)
    return rows, quarantine.broken(rows, SCHEMA)


@pytest.mark.parametrize("line,reasons", [
    ("x,2026-01-02T03:04:05,a,1.5", ["type:id"]),
    ("99999999999,2026-13-02,a,free", ["type:id", "type:at", "type:fare"]),
    ("1,2026-01-02T03:04:05,a", ["fields"]),
    ("1,2026-01-02T03:04:05,a,1.5,more", ["fields"]),
    ("x,2026-01-02T03:04:05", ["type:id", "fields"]),
    ('1,2026-01-02T03:04:05,"a,b,c,1.5', ["fields"]),
    ("1.5,2026-01-02T03:04:05,a,1.5", ["type:id"]),
])
def test_reasons_of_a_line(spark, line, reasons):
    rows, aside = _reasons(spark, [GOOD, line])
    assert [(r["line"], r["reasons"]) for r in aside.collect()] == [(line, reasons)]
    assert [r["id"] for r in quarantine.good(rows).collect()] == [1]


def test_empty_fields_quotes_and_empty_lines_are_good(spark):
    rows, aside = _reasons(spark, [GOOD, "", ",,,", '2,2026-01-02T03:04:05,"a,b",NaN', "3,,é ü,1e300"])
    assert aside.count() == 0
    assert [(r["id"], r["name"]) for r in quarantine.good(rows).collect()] == [(1, "a"), (None, None), (2, "a,b"), (3, "é ü")]


def test_required_columns(spark):
    rows, aside = _reasons(spark, [GOOD, ",2026-01-02T03:04:05,,2.0", "x,2026-01-02T03:04:05,a,1.5"], ("id", "name"))
    assert {tuple(r["reasons"]) for r in aside.collect()} == {("missing:id", "missing:name"), ("type:id",)}
    assert quarantine.good(rows).count() == 1
    assert ",2026-01-02T03:04:05" in {r["line"][:20] for r in aside.collect()}


def test_no_broken_value_is_pruned_away(spark):
    """A query of one column still leaves out rows that are broken in another."""
    rows, _ = _reasons(spark, [GOOD, "2,2026-01-02T03:04:05,a,free", "3,2026-01-02T03:04:05,a"])
    assert [r["id"] for r in quarantine.good(rows).select("id").collect()] == [1]
    assert quarantine.good(rows).agg(F.count(F.lit(1))).first()[0] == 1


def test_no_rows(spark):
    rows, aside = _reasons(spark, [])
    assert rows.count() == aside.count() == quarantine.report(aside).count() == 0


def test_report_counts_every_reason(spark):
    _, aside = _reasons(spark, ["x,y,a,1.5", "z,2026-01-02T03:04:05,a,1.5"])
    assert {(r["reason"], r["row_count"]) for r in quarantine.report(aside).collect()} == {("type:id", 2), ("type:at", 1)}


# -- month runs ---------------------------------------------------------------

def _trip(i, **other):
    row = {f.name: "" for f in TRIP_SOURCE.fields}
    row |= {"hvfhs_license_num": "HV0003", "dispatching_base_num": "B00001", "request_datetime": "2026-01-05T08:00:00", "pickup_datetime": "2026-01-05T08:05:00",
            "dropoff_datetime": "2026-01-05T08:25:00", "PULocationID": "1", "DOLocationID": "2", "trip_miles": str(i), "trip_time": "1200",
            "base_passenger_fare": "10.0", "driver_pay": "8.0"}
    return ",".join((row | other).values())


HEADER = ",".join(TRIP_SOURCE.names)
CSV = Settings(landing_format="csv")


def _land(root, month, lines, name="part.csv"):
    _file(f"{root}/raw/month={month}", [HEADER, *lines], name)


def _state(r):
    aside = {(x["_source_month"], tuple(x["reasons"])) for x in r._read("quarantine").collect()} if r._exists("quarantine") else set()
    return {x["_source_month"]: x["n"] for x in r._read("bronze").groupBy("_source_month").agg(F.count(F.lit(1)).alias("n")).collect()}, aside


def test_run_puts_every_line_into_one_of_two_tables(spark):
    root = scratch_root(spark, "csv_run")
    _land(root, "2026-01", [_trip(1), _trip(2, trip_time="n/a"), _trip(3)])
    _land(root, "2026-02", [_trip(4), _trip(5) + ",x"])
    r = MonthRunner(spark, Tables(root=root), root, CSV)
    r.bronze(["2026-01", "2026-02"])
    assert _state(r) == ({"2026-01": 2, "2026-02": 1}, {("2026-01", ("type:trip_time",)), ("2026-02", ("fields",))})
    assert {(x.month, x.rows) for x in r.results} == {("2026-01", 2), ("2026-02", 1)}
    # a corrected re-issue of one month takes its quarantined rows away, the other month's stay
    _land(root, "2026-01", [_trip(1), _trip(2), _trip(3)])
    again = MonthRunner(spark, Tables(root=root), root, CSV)
    assert again.bronze(["2026-01", "2026-02"]) == ["2026-01"]
    assert _state(again) == ({"2026-01": 3, "2026-02": 1}, {("2026-02", ("fields",))})


def test_a_crash_before_the_quarantine_loads_the_month_again(spark, monkeypatch):
    root = scratch_root(spark, "csv_crash")
    _land(root, "2026-01", [_trip(1), _trip(2, tips="free")])
    r = MonthRunner(spark, Tables(root=root), root, CSV)
    with monkeypatch.context() as m:
        m.setattr(r, "_set_aside", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            r.bronze(["2026-01"])
    # the ledger does not hold the month; without a ledger the guard would find its rows, so one exists
    later = MonthRunner(spark, Tables(root=root), root, Settings(landing_format="csv", load_mode="replace"))
    assert later.bronze(["2026-01"]) == ["2026-01"]
    assert _state(later) == ({"2026-01": 1}, {("2026-01", ("type:tips",))})


def test_months_without_folder_and_other_headers_are_errors(spark):
    root = scratch_root(spark, "csv_errors")
    _land(root, "2026-01", [_trip(1)])
    with pytest.raises(readers.MonthsNotLandedError):
        MonthRunner(spark, Tables(root=root), root, CSV).bronze(["2026-01", "2026-07"])
    _file(f"{root}/raw/month=2026-02", [HEADER.replace("tolls", "toll_sum"), _trip(1)])
    with pytest.raises(Exception, match="toll_sum"):
        MonthRunner(spark, Tables(root=root), root, CSV).bronze(["2026-02"])


def test_switched_runs_switch_the_quarantine_too(spark):
    root = scratch_root(spark, "csv_switched")
    zones = _file(f"{root}/zones", ["LocationID,Borough,Zone,service_zone", "1,b,z,s", "2,b,y,s"])
    _land(root, "2026-01", [_trip(1), _trip(2, trip_time="n/a")])
    t = Tables(database="quarantine_switched")
    spark.sql("DROP DATABASE IF EXISTS quarantine_switched CASCADE")
    SwitchedRunner(spark, t, root, CSV, lookup_csv=zones).run(["2026-01"])
    assert [r["reasons"] for r in spark.table("quarantine_switched.quarantine_trips").collect()] == [["type:trip_time"]]
    _land(root, "2026-01", [_trip(1), _trip(2), _trip(3)])
    SwitchedRunner(spark, t, root, CSV, lookup_csv=zones).run(["2026-01"])
    assert spark.table("quarantine_switched.quarantine_trips").count() == 0
    assert spark.table("quarantine_switched.bronze_trips").count() == 3
    spark.sql("DROP DATABASE quarantine_switched CASCADE")
