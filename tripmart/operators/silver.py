"""Bronze -> Silver: row-level flags and timing metrics, bad rows kept."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmart.functions import rules as R
from tripmart.schemas import SILVER_COLUMNS


def to_silver(bronze: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """One narrow projection; no shuffle, no rows dropped. ``more`` names added source columns that go along."""
    derived = bronze.withColumns(
        {
            "timestamp_quality_flag": R.timestamp_flag(),
            "financial_quality_flag": R.financial_flag(),
            "customer_wait_seconds": R.seconds_between("request_datetime", "pickup_datetime"),
            "driver_response_seconds": R.seconds_between("request_datetime", "on_scene_datetime"),
            "calculated_trip_time_seconds": R.seconds_between("pickup_datetime", "dropoff_datetime"),
        }
    )
    derived = derived.withColumns({"trip_time_consistent": R.trip_time_consistent()})
    derived = derived.withColumns({name: R.yn_to_bool(src) for name, src in R.YN_FLAGS.items()})
    derived = derived.withColumns({"overall_quality_status": R.overall_status()})
    cols = [c for c in SILVER_COLUMNS if c in derived.columns]
    return derived.select(*cols, *more)
