"""Silver row rules D1-D9 as plain Column expressions.

Every rule is a function returning a ``Column`` so that the whole Silver
projection is one ``withColumns`` call inside one whole-stage-codegen span.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart import config as C
from tripmart.functions.calendar import plausible

YN_FLAGS = {
    "shared_request": "shared_request_flag",
    "shared_match": "shared_match_flag",
    "access_a_ride": "access_a_ride_flag",
    "wav_request": "wav_request_flag",
    "wav_match": "wav_match_flag",
}


def seconds_between(start: str, end: str) -> Column:
    """end - start in whole seconds when end >= start, else NULL.

    ``unix_timestamp`` truncates each side to the second before subtracting.
    """
    return F.when(F.col(end) >= F.col(start), F.unix_timestamp(end) - F.unix_timestamp(start))


def timestamp_flag() -> Column:
    """ISSUE if the four timestamps are out of order; NULL comparisons alone never flag. A pick-up outside the
    calendar's span, which gets no date key, is an issue as well."""
    bad = (
        (F.col("request_datetime") > F.col("on_scene_datetime"))
        | (F.col("on_scene_datetime") > F.col("pickup_datetime"))
        | (F.col("pickup_datetime") > F.col("dropoff_datetime"))
        | ~plausible("pickup_datetime")
    )
    return F.when(bad, F.lit(C.ISSUE)).otherwise(F.lit(C.OK))


def financial_flag() -> Column:
    """ISSUE if fare or driver pay is negative."""
    bad = (F.col("base_passenger_fare") < 0) | (F.col("driver_pay") < 0)
    return F.when(bad, F.lit(C.ISSUE)).otherwise(F.lit(C.OK))


def trip_time_consistent(tolerance: int = C.TRIP_TIME_TOLERANCE_S) -> Column:
    """|trip_time - computed| <= tolerance; unknown -> False."""
    diff = F.abs(F.col("trip_time") - F.col("calculated_trip_time_seconds"))
    return F.coalesce(diff <= tolerance, F.lit(False))


def yn_to_bool(c: str) -> Column:
    """D7: 'Y' -> True, 'N' -> False, anything else (blank, NULL) -> NULL."""
    return F.when(F.col(c) == "Y", F.lit(True)).when(F.col(c) == "N", F.lit(False))


def overall_status() -> Column:
    """First matching label wins."""
    ts = F.col("timestamp_quality_flag") == C.ISSUE
    fin = F.col("financial_quality_flag") == C.ISSUE
    return (
        F.when(ts & fin, C.STATUS_BOTH)
        .when(ts, C.STATUS_TIMESTAMP)
        .when(fin, C.STATUS_FINANCIAL)
        .when(F.col("trip_time_consistent") == F.lit(False), C.STATUS_TRIP_TIME)
        .otherwise(C.STATUS_GOOD)
    )


def extreme_flags(miles: float = C.EXTREME_MILES, duration_s: int = C.EXTREME_DURATION_S) -> dict[str, Column]:
    """Zero / extreme distance and extreme duration; NULL -> False."""
    return {
        "zero_distance_flag": F.coalesce(F.col("trip_miles") == 0, F.lit(False)),
        "extreme_distance_flag": F.coalesce(F.col("trip_miles") > miles, F.lit(False)),
        "extreme_duration_flag": F.coalesce(F.col("trip_time") > duration_s, F.lit(False)),
    }


def guarded_ratio(num: str | Column, den: str | Column, scale: float | None = None) -> Column:
    """num / den when den > 0, else NULL (ANSI mode raises on x/0)."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    r = n / d
    if scale is not None:
        r = r * F.lit(scale)
    return F.when(d > 0, r)


#: values below this many ten-thousandths are summed as 64-bit integers, which holds for over four billion rows a group
LONG_SUM_BELOW = 2.0**31


def decimal_sum(c: str) -> Column:
    """Sum of a double column as DECIMAL(28,4), each value rounded half up to four places (``cast("decimal(18,4)")``).

    That cast goes through the value's decimal text. A value whose ten-thousandths lie within a quarter of a whole number (the
    product is off by less than a millionth there) rounds to that number, so it is added as an integer; all others are cast.
    """
    scaled = F.col(c) * 10000.0
    whole = F.rint(scaled)
    sure = F.coalesce((F.abs(scaled - whole) < 0.25) & (F.abs(scaled) < LONG_SUM_BELOW), F.lit(False))
    longs = F.sum(F.when(sure, whole.cast("long"))).cast("decimal(20,0)") * F.lit(Decimal("0.0001"))
    others = F.sum(F.when(~sure, F.col(c).cast("decimal(18,4)")))
    return F.coalesce(longs + others, longs, others).cast("decimal(28,4)")


def exact_sum(c: str) -> Column:
    """Order-independent sum of a money/miles double: DECIMAL(18,4) accumulation, returned as double.

    Double sums depend on row order (partitioning); the decimal path gives the
    same bits on every run and every cluster shape.
    """
    return decimal_sum(c).cast("double")
