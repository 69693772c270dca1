"""Profiling and integrity probes.

Each profile is ONE aggregate over the data; per-column profiles are one
aggregate followed by ``unpivot`` / ``stack`` (the reference ran one job per
column). Extracts and top lists carry a total order so ``limit`` is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import config as C
from tripmart.functions import rules as R
from tripmart.operators.quantiles import quantiles_from_counts, value_counts
from tripmart.schemas import BUSINESS_COLUMNS, TRIP_SOURCE

YN_SOURCE_FLAGS = list(R.YN_FLAGS.values())
KEY_PROFILE_COLUMNS = [
    "hvfhs_license_num", "request_datetime", "pickup_datetime", "dropoff_datetime", "PULocationID",
    "DOLocationID", "trip_miles", "trip_time", "base_passenger_fare", "driver_pay",
]


def _n(pred: Column) -> Column:
    return F.count_if(pred)


def group_count(df: DataFrame, cols: list[str], name: str = "trip_count") -> DataFrame:
    """H1: group count (partial + final hash aggregate)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def timestamp_order(df: DataFrame) -> DataFrame:
    """Three separate order-violation counts."""
    return df.select(
        F.count(F.lit(1)).alias("total_rows"),
        _n(F.col("request_datetime") > F.col("on_scene_datetime")).alias("request_after_on_scene"),
        _n(F.col("on_scene_datetime") > F.col("pickup_datetime")).alias("on_scene_after_pickup"),
        _n(F.col("pickup_datetime") > F.col("dropoff_datetime")).alias("pickup_after_dropoff"),
    )


NEGATIVE_MEASURES = {
    "negative_trip_miles": "trip_miles",
    "negative_trip_time": "trip_time",
    "negative_base_fare": "base_passenger_fare",
    "negative_tolls": "tolls",
    "negative_bcf": "bcf",
    "negative_sales_tax": "sales_tax",
    "negative_tips": "tips",
    "negative_driver_pay": "driver_pay",
}


def negatives(df: DataFrame) -> DataFrame:
    """Negative-value counts for eight measures."""
    return df.select(*[_n(F.col(c) < 0).alias(a) for a, c in NEGATIVE_MEASURES.items()])


def flag_value_counts(df: DataFrame, flags: list[str] = YN_SOURCE_FLAGS) -> DataFrame:
    """Value counts of every Y/N flag column from ONE scan (unpivot, then one group-by)."""
    long = df.select(*flags).unpivot([], flags, "flag_column", "flag_value")
    return long.groupBy("flag_column", "flag_value").agg(F.count(F.lit(1)).alias("trip_count"))


def locations(df: DataFrame) -> DataFrame:
    """Location NULL counts and id range."""
    return df.select(
        F.count(F.lit(1)).alias("total_rows"),
        _n(F.col("PULocationID").isNull()).alias("null_pickup_location"),
        _n(F.col("DOLocationID").isNull()).alias("null_dropoff_location"),
        F.min("PULocationID").alias("min_pickup_location"),
        F.max("PULocationID").alias("max_pickup_location"),
        F.min("DOLocationID").alias("min_dropoff_location"),
        F.max("DOLocationID").alias("max_dropoff_location"),
    )


def ranges(df: DataFrame) -> DataFrame:
    """H5: min / max / avg profile (averages from exact sums)."""
    return df.select(
        F.min("trip_miles").alias("min_trip_miles"),
        F.max("trip_miles").alias("max_trip_miles"),
        (R.exact_sum("trip_miles") / F.count("trip_miles")).alias("avg_trip_miles"),
        F.min("trip_time").alias("min_trip_time"),
        F.max("trip_time").alias("max_trip_time"),
        (F.sum("trip_time").cast("double") / F.count("trip_time")).alias("avg_trip_time"),
        F.min("base_passenger_fare").alias("min_base_fare"),
        F.max("base_passenger_fare").alias("max_base_fare"),
        F.min("driver_pay").alias("min_driver_pay"),
        F.max("driver_pay").alias("max_driver_pay"),
    )


def time_range(df: DataFrame) -> DataFrame:
    """Pickup coverage per file month."""
    return df.groupBy("_source_month").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.min("pickup_datetime").alias("min_pickup_datetime"),
        F.max("pickup_datetime").alias("max_pickup_datetime"),
    )


def nulls_wide(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """H7: NULL count per column, one row."""
    cols = cols or [f.name for f in TRIP_SOURCE.fields]
    return df.select(*[_n(F.col(c).isNull()).alias(f"null_{c}") for c in cols])


def nulls_long(df: DataFrame, cols: list[str] = KEY_PROFILE_COLUMNS) -> DataFrame:
    """H8: NULL counts as (column_name, null_count) from ONE aggregate + unpivot."""
    wide = df.select(*[_n(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "null_count")


def duplicate_groups(df: DataFrame, cols: list[str] = BUSINESS_COLUMNS) -> DataFrame:
    """H9: groups of identical rows (HAVING count > 1): number of groups and rows in them."""
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return g.agg(F.count(F.lit(1)).alias("duplicate_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("duplicated_rows"))


def key_uniqueness(df: DataFrame, key: str, label: str) -> DataFrame:
    """H9 / N19 for one dimension or fact key: rows, distinct keys, repeated keys, NULL keys."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(
        F.lit(label).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count(key).alias("distinct_keys"),
        F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
    )


def anomaly_matrix(silver: DataFrame, miles: float = C.EXTREME_MILES, duration_s: int = C.EXTREME_DURATION_S) -> DataFrame:
    """Cross-tab of the three extreme-value flags."""
    flags = R.extreme_flags(miles, duration_s)
    return silver.groupBy(*[v.alias(k) for k, v in flags.items()]).agg(F.count(F.lit(1)).alias("trip_count"))


STATS = ["count", "mean", "stddev", "min", "25%", "50%", "75%", "max"]


def _stats_rows(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """count, mean, stddev, min, 25%, 50%, 75%, max per column as rows (statistic, <col>...).

    ONE pass over the data: counts per (column, distinct value), map-side
    combined and checkpointed to the shared folder. Moments (exact integer
    sums) and exact, fully distributed quartiles are then derived from those
    counts; the result is pivoted to one column per input column.
    """
    counts = value_counts(df, cols).checkpoint(eager=True)
    v = F.col("v").cast("decimal(20,0)")
    n = F.col("n").cast("decimal(20,0)")
    moments = counts.groupBy("column_name").agg(
        F.sum("n").cast("double").alias("cnt"),
        F.sum(v * n).cast("double").alias("s"),
        F.sum(v * v * n).cast("double").alias("q"),
        F.min("v").cast("double").alias("mn"),
        F.max("v").cast("double").alias("mx"),
    )

    def entry(stat: str, value: Column) -> Column:
        return F.struct(F.lit(stat).alias("statistic"), value.cast("double").alias("value"))

    c, s_, q = F.col("cnt"), F.col("s"), F.col("q")
    long = moments.select("column_name", F.explode(F.array(
        entry("count", c),
        entry("mean", F.when(c > 0, s_ / c)),
        entry("stddev", F.round(F.when(c > 1, F.sqrt((q - s_ * s_ / c) / (c - 1))), digits)),
        entry("min", F.col("mn")),
        entry("max", F.col("mx")),
    )).alias("e")).select("column_name", "e.*")
    quart = quantiles_from_counts(counts, [0.25, 0.5, 0.75]).select(
        "column_name", F.element_at(F.array(F.lit("25%"), F.lit("50%"), F.lit("75%")), F.col("p_index") + 1).alias(
            "statistic"), "value")
    long = long.unionByName(quart)
    wide = long.groupBy("statistic").pivot("column_name", cols).agg(F.first("value", ignorenulls=True))
    # statistics of an all-NULL input still get their rows (count 0, the rest NULL)
    stats = df.sparkSession.createDataFrame([(st, i) for i, st in enumerate(STATS)], "statistic string, __o int")
    out = stats.join(wide, "statistic", "left").orderBy("__o").drop("__o")
    is_count = F.col("statistic") == "count"
    return out.select("statistic", *[F.when(is_count, F.coalesce(F.col(x), F.lit(0.0))).otherwise(F.col(x)).alias(x)
                                     for x in cols])


def summary_timestamp_gap(df: DataFrame) -> DataFrame:
    """|on_scene - request| seconds where request is after on-scene."""
    gap = F.abs(F.unix_timestamp("on_scene_datetime") - F.unix_timestamp("request_datetime"))
    src = df.where(F.col("request_datetime") > F.col("on_scene_datetime")).select(gap.alias("seconds_difference"))
    return _stats_rows(src, ["seconds_difference"])


def trip_time_diff(df: DataFrame) -> DataFrame:
    """The trips with computed trip time and its difference to the reported one."""
    calc = F.unix_timestamp("dropoff_datetime") - F.unix_timestamp("pickup_datetime")
    return df.withColumn("calculated_trip_time_seconds", calc).withColumn(
        "difference_seconds", F.col("trip_time") - F.col("calculated_trip_time_seconds"))


def summary_trip_time_diff(df: DataFrame) -> DataFrame:
    """Statistics of reported and computed trip time and their difference."""
    return _stats_rows(trip_time_diff(df), ["trip_time", "calculated_trip_time_seconds", "difference_seconds"])


def anti_members(values: DataFrame, col: str, members: DataFrame, member_col: str, out: str) -> DataFrame:
    """Distinct values absent from a member set (left anti; NULL values are kept once)."""
    v = values.select(F.col(col).alias(out)).distinct()
    m = members.select(F.col(member_col).alias(out)).distinct()
    return v.join(m, out, "left_anti")


def both_roles(silver: DataFrame) -> DataFrame:
    """Bases that dispatch AND originate trips (inner join of two distinct sets)."""
    d = silver.select(F.col("dispatching_base_num").alias("base_num")).where(F.col("base_num").isNotNull()).distinct()
    o = silver.select(F.col("originating_base_num").alias("base_num")).where(F.col("base_num").isNotNull()).distinct()
    return d.join(o, "base_num", "inner")


def month_bases(silver: DataFrame) -> DataFrame:
    """C4 / K1: (month, base) members written as SQL strings: selectExpr + where + distinct."""
    return (
        silver.selectExpr("_source_month", "explode(array(dispatching_base_num, originating_base_num)) AS base_num")
        .where("base_num IS NOT NULL")
        .distinct()
    )
