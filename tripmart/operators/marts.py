"""Gold marts (L1-L7, R1-R5) as partial aggregates + a finishing projection.

Every mart is computed as additive partials (sums and non-NULL counts,
exact DECIMAL sums for money and miles) at a fine grain, then re-aggregated
to the mart grain and finished (averages, per-mile KPIs). Partials can be
stored per ``_source_month`` and rolled up later, so a new month never needs
a rebuild of the whole fact. Dimension names are joined AFTER aggregation:
a few hundred groups are joined, not every trip. Those joins carry no
broadcast hint: both sides are aggregates whose size is only known at run
time, so AQE measures them after the aggregate stage and switches to a
broadcast join only when the measured side is under its threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import config as C
from tripmart.functions.rules import decimal_sum, guarded_ratio

DEC = "decimal(28,4)"


def trip_partials(duration_col: str = "trip_time") -> list[Column]:
    """Additive measures of one group of trips."""
    return [
        F.count(F.lit(1)).alias("total_trips"),
        decimal_sum("trip_miles").alias("miles_sum"),
        F.count("trip_miles").alias("miles_n"),
        F.sum(F.col(duration_col)).cast("long").alias("dur_sum"),
        F.count(duration_col).alias("dur_n"),
        F.sum("customer_wait_seconds").cast("long").alias("wait_sum"),
        F.count("customer_wait_seconds").alias("wait_n"),
        decimal_sum("base_passenger_fare").alias("fare_sum"),
        decimal_sum("tips").alias("tips_sum"),
        decimal_sum("driver_pay").alias("pay_sum"),
        F.count_if(F.col("overall_quality_status") != C.STATUS_GOOD).alias("quality_issue_trips"),
        F.count_if(F.col("shared_request") == F.lit(True)).alias("shared_requests"),
        F.count_if(F.col("shared_match") == F.lit(True)).alias("shared_matches"),
    ]


PARTIAL_SUMS = ["total_trips", "miles_sum", "miles_n", "dur_sum", "dur_n", "wait_sum", "wait_n", "fare_sum",
                "tips_sum", "pay_sum", "quality_issue_trips", "shared_requests", "shared_matches"]


def partials(fact: DataFrame, grain: list[str], duration_col: str = "trip_time") -> DataFrame:
    """Partial aggregate of the fact at ``grain`` (two-step hash aggregate, map-side combine)."""
    return fact.groupBy(*grain).agg(*trip_partials(duration_col))


def rollup(parts: DataFrame, grain: list[str]) -> DataFrame:
    """Re-aggregate stored partials to a coarser grain (sums of sums are exact)."""
    aggs = []
    for c in PARTIAL_SUMS:
        e = F.sum(c)
        if c.endswith("_sum") and c not in ("dur_sum", "wait_sum"):
            e = e.cast(DEC)
        aggs.append(e.alias(c))
    return parts.groupBy(*grain).agg(*aggs)


def _avg(s: str, n: str) -> Column:
    return guarded_ratio(F.col(s).cast("double"), F.col(n).cast("double"))


def finish(df: DataFrame, keys: list[str], kind: str, rounded: bool = False) -> DataFrame:
    """Turn partial sums into the mart's published columns."""
    miles = F.col("miles_sum").cast("double")
    fare = F.col("fare_sum").cast("double")
    pay = F.col("pay_sum").cast("double")
    r2 = (lambda c: F.round(c, 2)) if rounded else (lambda c: c)
    if kind == "shared":
        return df.select(
            *keys,
            "total_trips",
            "shared_requests",
            "shared_matches",
            r2(guarded_ratio(F.col("shared_requests"), F.col("total_trips"), 100.0)).alias("shared_request_rate"),
            r2(guarded_ratio(F.col("shared_matches"), F.col("total_trips"), 100.0)).alias("shared_match_rate"),
        )
    cols = [
        *keys,
        F.col("total_trips"),
        miles.alias("total_trip_miles"),
        (r2(_avg("miles_sum", "miles_n")) if kind == "location" else _avg("miles_sum", "miles_n")).alias("avg_trip_distance"),
        r2(_avg("dur_sum", "dur_n") / 60).alias("avg_trip_duration_minutes"),
        r2(_avg("wait_sum", "wait_n") / 60).alias("avg_customer_wait_minutes"),
        fare.alias("total_passenger_fare"),
        F.col("tips_sum").cast("double").alias("total_tips"),
        pay.alias("total_driver_pay"),
    ]
    if kind == "daily":
        cols.append(F.col("quality_issue_trips"))
    cols.append(r2(guarded_ratio(fare, miles)).alias("fare_per_mile"))
    if kind == "daily":
        cols.append(r2(guarded_ratio(pay, miles)).alias("driver_pay_per_mile"))
    return df.select(*cols)


# -- L1 / L2 -----------------------------------------------------------------

DAILY_GRAIN = ["date_key", "provider_key"]


def daily_partials(fact: DataFrame, duration_col: str = "trip_time") -> DataFrame:
    """Month-additive partials of the daily provider mart, keyed by file month too."""
    return partials(fact, ["_source_month", *DAILY_GRAIN], duration_col)


def daily_provider(parts: DataFrame, dim_date: DataFrame, dim_provider: DataFrame, rounded: bool = False) -> DataFrame:
    """L1 (rounded=False) / L2 (rounded=True): one row per date x provider."""
    g = rollup(parts, DAILY_GRAIN) if "_source_month" in parts.columns else parts
    g = g.join(dim_date.select("date_key", "date"), "date_key", "left")
    g = g.join(dim_provider.select("provider_key", "provider_name"), "provider_key", "left")
    return finish(g, ["date_key", "date", "provider_key", "provider_name"], "daily", rounded)


# One partial table feeds all three published marts. Its grain is bounded by
# days x providers x zones per month, independent of trip volume.
PARTIAL_GRAIN = ["_source_month", "date_key", "provider_key", "pickup_location_key"]


def published(parts: DataFrame, dim_date: DataFrame, dim_provider: DataFrame, dim_location: DataFrame
              ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(daily provider, pickup location, shared ride) marts rolled up from PARTIAL_GRAIN partials."""
    daily = daily_provider(rollup(parts, DAILY_GRAIN), dim_date, dim_provider)
    d = dim_location.select(F.col("location_key").alias("pickup_location_key"), "zone", "borough", "service_zone")
    loc = finish(rollup(parts, ["pickup_location_key"]).join(d, "pickup_location_key", "left"),
                 ["pickup_location_key", "zone", "borough", "service_zone"], "location")
    sh = rollup(parts, ["provider_key"]).join(dim_provider.select("provider_key", "provider_name"), "provider_key", "left")
    shared = finish(sh, ["provider_key", "provider_name"], "shared")
    return daily, loc, shared


# -- L3 / L4 / R1 ------------------------------------------------------------

def location(fact: DataFrame, dim_location: DataFrame, role: str = "pickup", rounded: bool = False,
             duration_col: str = "trip_time") -> DataFrame:
    """L3 (pickup, unrounded), L4 (rounded, with location_id, computed duration), R1 (dropoff)."""
    k = f"{role}_location_key"
    g = partials(fact, [k], duration_col)
    d = dim_location.select(F.col("location_key").alias(k), "location_id", "zone", "borough", "service_zone")
    g = g.join(d, k, "left")
    keys = [k, "location_id", "borough", "zone", "service_zone"] if rounded else [k, "zone", "borough", "service_zone"]
    return finish(g, keys, "location", rounded)


# -- L5 / L6 / R3 ------------------------------------------------------------

def shared_ride(fact: DataFrame, dim_provider: DataFrame, rounded: bool = False) -> DataFrame:
    g = fact.groupBy("provider_key").agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.count_if(F.col("shared_request") == F.lit(True)).alias("shared_requests"),
        F.count_if(F.col("shared_match") == F.lit(True)).alias("shared_matches"),
    )
    g = g.join(dim_provider.select("provider_key", "provider_name"), "provider_key", "left")
    return finish(g, ["provider_key", "provider_name"], "shared", rounded)


def shared_request_match_share(shared: DataFrame) -> DataFrame:
    """Matched share of shared REQUESTS (the mart's rate divides by all trips)."""
    return shared.withColumn(
        "shared_request_match_share", guarded_ratio(F.col("shared_matches"), F.col("shared_requests"), 100.0)
    )


# -- R2 / R4 / R5 ------------------------------------------------------------

def demand_by_day_hour(fact: DataFrame) -> DataFrame:
    """R2: trips by weekday (Sunday = 1) and pickup hour."""
    return fact.groupBy(
        F.dayofweek("pickup_datetime").alias("day_of_week"),
        F.date_format("pickup_datetime", "EEEE").alias("day_name"),
        F.hour("pickup_datetime").alias("pickup_hour"),
    ).agg(F.count(F.lit(1)).alias("total_trips"))


CORR_MEASURES = ["trip_miles", "base_passenger_fare", "tips", "driver_pay"]


def measure_correlations(fact: DataFrame, measures: list[str] = CORR_MEASURES, digits: int = 8) -> DataFrame:
    """Pearson correlation of each measure pair from exact DECIMAL moment sums.

    One aggregate pass; the moments are order-independent, so the result is the
    same on every cluster shape. Then one row per pair.
    """
    pairs = [(a, b) for i, a in enumerate(measures) for b in measures[i + 1:]]
    aggs = [F.count(F.lit(1)).alias("n")]
    for m in measures:
        aggs.append(F.sum(F.col(m).cast("decimal(18,4)")).cast("decimal(38,4)").alias(f"s_{m}"))
        aggs.append(F.sum((F.col(m).cast("decimal(18,4)") * F.col(m).cast("decimal(18,4)"))).cast("decimal(38,8)").alias(f"q_{m}"))
    for a, b in pairs:
        aggs.append(F.sum(F.col(a).cast("decimal(18,4)") * F.col(b).cast("decimal(18,4)")).cast("decimal(38,8)").alias(f"x_{a}_{b}"))
    moments = fact.agg(*aggs)
    n = F.col("n").cast("double")

    def var(m):
        return n * F.col(f"q_{m}").cast("double") - F.col(f"s_{m}").cast("double") * F.col(f"s_{m}").cast("double")

    rows = []
    for a, b in pairs:
        cov = n * F.col(f"x_{a}_{b}").cast("double") - F.col(f"s_{a}").cast("double") * F.col(f"s_{b}").cast("double")
        den = F.sqrt(var(a) * var(b))
        rows.append(F.struct(F.lit(a).alias("measure_x"), F.lit(b).alias("measure_y"),
                             F.round(F.when(den > 0, cov / den), digits).alias("correlation")))
    return moments.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def top_k(df: DataFrame, order: list[Column], k: int = C.EXTRACT_ROWS) -> DataFrame:
    """Top-k with a total order (TakeOrderedAndProject: k rows per task, then k overall)."""
    return df.orderBy(*order).limit(k)
