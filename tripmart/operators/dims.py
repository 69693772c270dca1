"""Dimensions: location, provider, date, dispatch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart import config as C
from tripmart.functions.calendar import calendar_attributes, calendar_date
from tripmart.session import shared_dir

DIM_DATE_COLUMNS = [
    "date_key", "date", "year", "quarter", "month", "month_name",
    "week_of_year", "day_of_month", "day_of_week", "day_name", "is_weekend",
]


def dim_location(lookup: DataFrame) -> DataFrame:
    """location_key = location_id, plus borough, zone, service_zone."""
    return lookup.select(
        F.col("LocationID").cast("int").alias("location_key"),
        F.col("LocationID").cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        F.col("service_zone"),
    )


def new_locations(zones: DataFrame, existing: DataFrame) -> DataFrame:
    """Zones of a newer lookup that the dimension does not hold yet (those it holds never change)."""
    return zones.join(existing.select("location_key"), "location_key", "left_anti").select(*existing.columns)


def provider_name(code: Column, names: dict[str, str] | None = None) -> Column:
    """Licence code -> provider name through a literal map; unmapped -> Unknown."""
    names = names or C.PROVIDER_NAMES
    m = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(m[code], F.lit(C.UNKNOWN_PROVIDER))


def dim_provider(trips: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """distinct licence codes of the trips (map-side partial distinct), key = code."""
    codes = trips.select(F.col("hvfhs_license_num").alias("provider_code")).distinct()
    return codes.select(
        F.col("provider_code").alias("provider_key"),
        "provider_code",
        provider_name(F.col("provider_code"), names).alias("provider_name"),
    )


def dim_provider_known(spark: SparkSession, names: dict[str, str] | None = None) -> DataFrame:
    """Provider dimension of the known codes only (an unknown code then gets a NULL key)."""
    names = names or C.PROVIDER_NAMES
    rows = [(k, k, v) for k, v in names.items()]
    return spark.createDataFrame(rows, "provider_key string, provider_code string, provider_name string")


def dim_date_range(spark: SparkSession, start: str = C.DIM_DATE_START, end: str = C.DIM_DATE_END) -> DataFrame:
    """one row per day of a fixed calendar window (the reference's 2026-01..2026-05)."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("interval 1 day"))).alias("date")
    )
    return days.withColumns(calendar_attributes("date")).select(*DIM_DATE_COLUMNS)


def _days(span: DataFrame) -> DataFrame:
    """One row per day of a one-row span (d0, d1) of plausible dates."""
    return span.select(F.explode(F.sequence("d0", "d1", F.expr("interval 1 day"))).alias("date"))


def _span(trips: DataFrame, ts_col: str) -> DataFrame:
    """First and last date of the trips; broken timestamps have none."""
    return trips.agg(F.min(calendar_date(ts_col)).alias("d0"), F.max(calendar_date(ts_col)).alias("d1"))


def dim_date_for(trips: DataFrame, ts_col: str = "pickup_datetime") -> DataFrame:
    """F3 over the data's own span: min..max pickup date, computed on the cluster (no collect).

    The exploded calendar is bounded by the number of days in the span, not by the row count.
    """
    days = _days(_span(trips, ts_col))
    return days.withColumns(calendar_attributes("date")).select(*DIM_DATE_COLUMNS)


def member_values(trips: DataFrame) -> DataFrame:
    """(kind, value) of every dimension member in ONE scan: provider codes, bases and pickup dates, distinct.

    Bounded by the dimensions, not by the trips; combined per task before it is shuffled.
    """
    return trips.select(
        F.explode(F.array(
            F.struct(F.lit("provider").alias("kind"), F.col("hvfhs_license_num").alias("value")),
            F.struct(F.lit("base").alias("kind"), F.col("dispatching_base_num").alias("value")),
            F.struct(F.lit("base").alias("kind"), F.col("originating_base_num").alias("value")),
            F.struct(F.lit("date").alias("kind"), calendar_date("pickup_datetime").cast("string").alias("value")),
        )).alias("m")).select("m.*").distinct()


def as_trips(members: DataFrame, kind: str) -> DataFrame:
    """The members of one kind as a trip-shaped frame that the dimension builders take."""
    own = members.where(F.col("kind") == kind)
    if kind == "provider":
        return own.select(F.col("value").alias("hvfhs_license_num"))
    if kind == "date":
        return own.select(F.col("value").cast("timestamp").alias("pickup_datetime"))
    return own.select(F.col("value").alias("dispatching_base_num"), F.lit(None).cast("string").alias("originating_base_num"))


def new_providers(trips: DataFrame, existing: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Provider members that the dimension does not hold yet; a NULL code counts as one member."""
    new, held = dim_provider(trips, names), existing.select(F.col("provider_key").alias("__held"))
    return new.join(held, new["provider_key"].eqNullSafe(held["__held"]), "left_anti")


def dim_date_extension(trips: DataFrame, existing: DataFrame, ts_col: str = "pickup_datetime") -> DataFrame:
    """Days to append so the calendar covers min..max of existing AND new dates, without gaps.

    The span is computed from two one-row aggregates; only missing days are returned.
    """
    new = _span(trips, ts_col)
    old = existing.agg(F.min("date").alias("d0"), F.max("date").alias("d1"))
    span = new.unionByName(old).agg(F.min("d0").alias("d0"), F.max("d1").alias("d1"))
    days = _days(span)
    cal = days.withColumns(calendar_attributes("date")).select(*DIM_DATE_COLUMNS)
    return cal.join(existing.select("date_key"), "date_key", "left_anti").select(*DIM_DATE_COLUMNS)


def dispatch_members(trips: DataFrame) -> DataFrame:
    """non-NULL dispatching and originating bases, distinct, from ONE scan (explode of a pair)."""
    return (
        trips.select(F.explode(F.array("dispatching_base_num", "originating_base_num")).alias("base_num"))
        .where(F.col("base_num").isNotNull())
        .distinct()
    )


def sequence_numbers(df: DataFrame, order_col: str, out_col: str, offset: Column | int = 0,
                     partitions: int | None = None) -> DataFrame:
    """Consecutive 1-based numbers by ``order_col`` without a single-partition window.

    Range-partition, number rows inside each partition, then add the running
    total of the sizes of the earlier partitions (one row per partition, so
    that side is tiny and broadcast). ``order_col`` values must be distinct.

    The range-partitioned rows are checkpointed with their partition number: range bounds
    come from a sample, so evaluating the partitioning twice could give two different ones.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared_dir(df.sparkSession)
    parted = df.repartitionByRange(n, order_col).withColumn("__p", F.spark_partition_id()).checkpoint(eager=True)
    local = parted.withColumn("__r", F.row_number().over(Window.partitionBy("__p").orderBy(order_col)))
    sizes = parted.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    starts = sizes.select(
        "__p",
        (F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))).alias("__s"),
    ).fillna(0, subset=["__s"])
    off = offset if isinstance(offset, Column) else F.lit(offset)
    # ``starts`` has exactly one row per range partition (n rows): a proven bound.
    return (
        local.join(F.broadcast(starts), "__p")
        .withColumn(out_col, (F.col("__s") + F.col("__r") + off).cast("long"))
        .drop("__p", "__r", "__s")
    )


def dim_dispatch(trips: DataFrame, key_mode: str = "natural") -> DataFrame:
    """dispatch dimension (dispatch_key, base_num)."""
    members = dispatch_members(trips)
    if key_mode == "surrogate":
        return sequence_numbers(members, "base_num", "dispatch_key").select("dispatch_key", "base_num")
    return members.select(F.col("base_num").alias("dispatch_key"), "base_num")


def new_dispatch_members(trips: DataFrame, existing: DataFrame) -> DataFrame:
    """the month's members that the dimension does not hold yet (left anti join)."""
    return dispatch_members(trips).join(existing.select("base_num"), "base_num", "left_anti")


def dispatch_delta(trips: DataFrame, existing: DataFrame, key_mode: str = "natural") -> DataFrame:
    """Rows to append; existing keys untouched, surrogate keys continue after max(key)."""
    new = new_dispatch_members(trips, existing)
    if key_mode == "surrogate":
        top = existing.agg(F.coalesce(F.max(F.col("dispatch_key").cast("long")), F.lit(0)).alias("m")).first()["m"]
        return sequence_numbers(new, "base_num", "dispatch_key", offset=int(top)).select("dispatch_key", "base_num")
    return new.select(F.col("base_num").alias("dispatch_key"), "base_num")


def dispatch_union_rebuild(trips: DataFrame, existing: DataFrame) -> DataFrame:
    """rebuild by union with the existing members, distinct (natural keys)."""
    members = existing.select("base_num").unionByName(dispatch_members(trips)).distinct()
    return members.select(F.col("base_num").alias("dispatch_key"), "base_num")
