"""Silver rules D1-D9 on hand-made rows: NULLs, equal, reversed, boundaries."""

import datetime as dt

import pytest

from tripmart.functions import rules as R
from tripmart.operators.silver import to_silver
from tripmart.schemas import TRIP_SOURCE

T0 = dt.datetime(2026, 1, 1, 8, 0, 0)


def s(sec):
    return None if sec is None else T0 + dt.timedelta(seconds=sec)


def trip(req=0, scene=10, pick=20, drop=120, trip_time=100, fare=10.0, pay=8.0, miles=1.0, flags=("Y", "N", " ", "Y", None)):
    return (
        "HV0003", "B00001", None, s(req), s(scene), s(pick), s(drop), 1, 2, miles, trip_time, fare, 0.0, 0.0, 0.0,
        0.0, 0.0, 0.0, pay, 0.0, *flags,
    )


@pytest.fixture(scope="module")
def silver(spark):
    rows = [
        trip(),                                   # 0 GOOD
        trip(scene=None),                         # 1 NULL on_scene alone: OK
        trip(scene=None, drop=10),                # 2 NULL on_scene OR pickup>dropoff -> ISSUE
        trip(scene=25),                           # 3 on_scene after pickup
        trip(drop=10),                            # 4 dropoff before pickup -> computed NULL
        trip(fare=-1.0),                          # 5 financial
        trip(fare=-1.0, drop=10),                 # 6 both
        trip(trip_time=103),                      # 7 |diff| = 3 -> consistent
        trip(trip_time=104),                      # 8 |diff| = 4 -> TRIP_TIME_ISSUE
        trip(trip_time=None),                     # 9 unknown -> not consistent
        trip(req=20, scene=20, pick=20, drop=20, trip_time=0),  # 10 all equal: GOOD, zero seconds
        trip(miles=0.0),                          # 11 zero distance
        trip(miles=500.5, trip_time=21601, drop=20 + 21601),   # 12 extremes
        trip(req=30, scene=None),                 # 13 pickup before request -> wait NULL, not a D1 issue
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "rid int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRIP_SOURCE.fields))
    df = df.withColumn("_source_month", df.rid.cast("string")).withColumn("_source_file", df.rid.cast("string"))
    from pyspark.sql import functions as F
    df = df.withColumn("_ingested_at", F.current_timestamp())
    out = to_silver(df).withColumns(R.extreme_flags()).collect()
    return {int(r["_source_month"]): r for r in out}


def test_timestamp_flag_three_valued(silver):
    assert silver[0]["timestamp_quality_flag"] == "OK"
    assert silver[1]["timestamp_quality_flag"] == "OK"
    assert silver[2]["timestamp_quality_flag"] == "ISSUE"
    assert silver[3]["timestamp_quality_flag"] == "ISSUE"
    assert silver[10]["timestamp_quality_flag"] == "OK"


def test_seconds_metrics(silver):
    assert silver[0]["customer_wait_seconds"] == 20
    assert silver[0]["driver_response_seconds"] == 10
    assert silver[1]["driver_response_seconds"] is None
    assert silver[13]["customer_wait_seconds"] is None
    assert silver[13]["timestamp_quality_flag"] == "OK"
    assert silver[4]["calculated_trip_time_seconds"] is None
    assert silver[10]["calculated_trip_time_seconds"] == 0


def test_consistency_boundary(silver):
    assert silver[7]["trip_time_consistent"] is True
    assert silver[8]["trip_time_consistent"] is False
    assert silver[9]["trip_time_consistent"] is False
    assert silver[4]["trip_time_consistent"] is False


def test_overall_status_precedence(silver):
    st = {k: v["overall_quality_status"] for k, v in silver.items()}
    assert st[0] == "GOOD"
    assert st[4] == "TIMESTAMP_ISSUE"
    assert st[5] == "FINANCIAL_ISSUE"
    assert st[6] == "TIMESTAMP_AND_FINANCIAL_ISSUE"
    assert st[8] == "TRIP_TIME_ISSUE"
    assert st[9] == "TRIP_TIME_ISSUE"


def test_yn_flags(silver):
    r = silver[0]
    assert (r["shared_request"], r["shared_match"], r["access_a_ride"], r["wav_request"], r["wav_match"]) == (
        True, False, None, True, None)


def test_extreme_flags(silver):
    assert silver[11]["zero_distance_flag"] is True
    assert silver[0]["zero_distance_flag"] is False
    assert silver[12]["extreme_distance_flag"] is True
    assert silver[12]["extreme_duration_flag"] is True
    assert silver[0]["extreme_duration_flag"] is False
