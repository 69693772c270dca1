"""The one-month public functions, called in the reference's order, twice (second call skips)."""

from tripmart import api
from tripmart.config import Tables
from tripmart.plans.monthly import landing_months
from tripmart.session import scratch_root
from tripmart.sources.fixture import land_months, location_lookup

from .conftest import SF_SMALL


def test_month_by_month_api(spark):
    raw = scratch_root(spark, "api_raw")
    land_months(spark, SF_SMALL, raw)
    lookup = f"{raw}/zones"
    location_lookup(spark, SF_SMALL).write.option("header", True).csv(lookup)
    m = landing_months(spark, raw)[0]
    t = Tables(root=scratch_root(spark, "api_tables"))
    n = api.ingest_month_to_bronze(spark, raw, m, t)
    assert n > 0
    assert api.ingest_month_to_bronze(spark, raw, m, t) == 0  # guard: already loaded
    assert api.transform_month_to_silver(spark, m, t).count() == n
    assert api.update_dispatch_dimension(spark, m, t, lookup_csv=lookup).count() > 0
    assert api.build_month_to_fact(spark, m, t).count() == n
    daily = api.build_daily_provider_gold(spark, m, t)
    assert daily.agg({"total_trips": "sum"}).first()[0] == n
    assert api.build_location_gold(spark, t).agg({"total_trips": "sum"}).first()[0] == n
    assert api.build_shared_ride_gold(spark, t).agg({"total_trips": "sum"}).first()[0] == n
    checks = dict(api.run_data_quality_checks(spark, m, t))
    assert checks["Silver row count"] == "PASS" and checks["Silver → Fact row reconciliation"] == "PASS"
    again = dict(api.run_month(spark, m, t, raw, lookup_csv=lookup))
    assert again == checks
