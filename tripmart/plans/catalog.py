"""The registered queries: one callable per operator key of SURVEY section 2.

Every callable takes ``(spark, sf_dir)``, reads the supplied tables of that
scale factor (through the trip-shaped landing view) over their WHOLE extent,
and returns a DataFrame. Keys that persist write under a fresh folder inside
the shared checkpoint location and return the read-back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import config as C
from tripmart.config import SchemaChange, Settings, Tables
from tripmart.operators import dims, identity, marts, profile, quality, sketches
from tripmart.operators.fact import build_fact, trip_key
from tripmart.operators.silver import to_silver
from tripmart.plans.monthly import MonthRunner, landing_months
from tripmart.schemas import SILVER_COLUMNS, TRIP_KEY_COLUMNS, TRIP_SOURCE
from tripmart.session import prepare, scratch_root, shared_dir
from tripmart.sources import quarantine, readers, sinks
from tripmart.sources.fixture import bronze_view, land_months, land_text_months, location_lookup

RUN_DEPENDENT = ["_source_file", "_ingested_at"]


class Inputs:
    """Lazily derived frames of one query call (silver materialised once when reused)."""

    def __init__(self, spark: SparkSession, sf_dir: str, settings: Settings = Settings()):
        prepare(spark)
        self.spark, self.sf, self.s = spark, sf_dir, settings

    def scratch(self, label: str) -> str:
        return scratch_root(self.spark, label)

    @cached_property
    def bronze(self) -> DataFrame:
        return bronze_view(self.spark, self.sf)

    @cached_property
    def silver(self) -> DataFrame:
        """Lazy Silver: for single-consumer queries (one pass, nothing written)."""
        return to_silver(self.bronze)

    def materialize(self, df: DataFrame, label: str) -> DataFrame:
        """Write once to the shared folder and read back: cuts lineage for plans with several consumers
        (dimensions, lookups, fact). Unpartitioned: these consumers read it whole."""
        path = self.scratch(label)
        df.write.mode("overwrite").options(**sinks.PARQUET).parquet(path)
        return readers.read_table(self.spark, path)

    @cached_property
    def silver_table(self) -> DataFrame:
        """All of Silver, written: for runs that read most of its columns several times."""
        return self.materialize(self.silver, "silver")

    @cached_property
    def members(self) -> DataFrame:
        """Members of all dimensions from ONE scan of four Silver columns, checkpointed (bounded by the dimensions)."""
        shared_dir(self.spark)
        return dims.member_values(self.silver).checkpoint(eager=True)

    @cached_property
    def silver_by_month(self) -> DataFrame:
        """Silver as a month-partitioned table (month filters become partition filters)."""
        path = self.scratch("silver_by_month")
        sinks.write_months(self.silver, path)
        return readers.read_table(self.spark, path)

    @cached_property
    def dim_location(self) -> DataFrame:
        return dims.dim_location(location_lookup(self.spark, self.sf))

    @cached_property
    def dim_provider(self) -> DataFrame:
        return dims.dim_provider(dims.as_trips(self.members, "provider"), self.s.provider_names)

    @cached_property
    def dim_dispatch(self) -> DataFrame:
        return dims.dim_dispatch(dims.as_trips(self.members, "base"), self.s.dispatch_key_mode)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date_for(dims.as_trips(self.members, "date"))

    @cached_property
    def fact(self) -> DataFrame:
        """The whole fact, lazy over Silver: nothing but the members of its dimensions is written."""
        if self.s.fact_key_mode == "copy":  # keys are the raw ids: no dimension needed
            return build_fact(self.silver, None, None, None, self.s)
        return build_fact(self.silver, self.dim_provider, self.dim_location, self.dim_dispatch, self.s)

    def fact_of(self, *dimensions: str) -> DataFrame:
        """The fact with the keys of some dimensions only: a query looks up what it groups by."""
        got = {d: getattr(self, f"dim_{d}") if d in dimensions else None for d in ("provider", "location", "dispatch")}
        return build_fact(self.silver, got["provider"], got["location"], got["dispatch"], self.s)


# ---------------------------------------------------------------------------
# helpers

def _total_order(cols: list[str], first: Column | None = None) -> list[Column]:
    o = [first] if first is not None else []
    return o + [F.col(c).asc_nulls_last() for c in cols]


# Output columns of the reference's extracts and top lists.
EXTRACT_FARE_COLS = ["hvfhs_license_num", "request_datetime", "pickup_datetime", "dropoff_datetime", "trip_miles",
                     "trip_time", "base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge",
                     "airport_fee", "tips", "driver_pay"]
EXTRACT_PAY_COLS = ["hvfhs_license_num", "request_datetime", "pickup_datetime", "dropoff_datetime", "trip_miles",
                    "trip_time", "base_passenger_fare", "tips", "driver_pay"]
EXTRACT_TS_COLS = ["hvfhs_license_num", "dispatching_base_num", "originating_base_num", "request_datetime",
                   "on_scene_datetime", "pickup_datetime", "dropoff_datetime", "trip_miles", "trip_time"]
EXTRACT_ZERO_COLS = ["hvfhs_license_num", "request_datetime", "pickup_datetime", "dropoff_datetime", "PULocationID",
                     "DOLocationID", "trip_miles", "trip_time", "base_passenger_fare", "driver_pay",
                     "overall_quality_status"]
TOP_TRIP_COLS = ["hvfhs_license_num", "request_datetime", "pickup_datetime", "dropoff_datetime", "PULocationID",
                 "DOLocationID", "trip_miles", "trip_time", "calculated_trip_time_seconds", "base_passenger_fare",
                 "driver_pay", "overall_quality_status"]
PREVIEW_COLS = [c for c in SILVER_COLUMNS if c not in RUN_DEPENDENT]


def _extract(df: DataFrame, pred: Column, cols: list[str], k: int | None) -> DataFrame:
    out = df.where(pred).select(*cols)
    return out if k is None else marts.top_k(out, _total_order(cols), k)


# ---------------------------------------------------------------------------
# 2.1 / 2.2 sources and sinks

def q_bronze_ingest(spark, sf):
    """Land every month, ingest all of them into Bronze in one pass, read back."""
    i = Inputs(spark, sf)
    root = i.scratch("bronze_ingest")
    land_months(spark, sf, root)
    t = Tables(root=root)
    r = MonthRunner(spark, t, root)
    r.bronze(landing_months(spark, root))
    # of the file name, which differs from run to run, the month folder is compared
    month = F.regexp_extract("_source_file", "month=([0-9]{4}-[0-9]{2})/", 1).alias("source_file_month")
    return readers.read_table(spark, t.path("bronze")).select("*", month).drop(*RUN_DEPENDENT)


def q_scan_csv_lookup(spark, sf):
    """A2: the zone lookup written as CSV with a header, scanned back with a declared schema."""
    i = Inputs(spark, sf)
    path = i.scratch("zone_lookup_csv")
    location_lookup(spark, sf).write.option("header", True).csv(path)
    return readers.read_lookup_csv(spark, path)


def q_month_slice(spark, sf, month: str = "1995-01"):
    """A4: one month of Silver; the month is a range of order dates at the landing scan, nothing is written."""
    prepare(spark)
    return readers.month_slice(to_silver(bronze_view(spark, sf, [month])), month).drop(*RUN_DEPENDENT)


def q_source_inventory(spark, sf):
    """Landing-folder inventory as a table; file names and sizes differ from run to run, so per month: rows, and
    whether every file has bytes and rows."""
    i = Inputs(spark, sf)
    root = i.scratch("inventory")
    land_months(spark, sf, root)
    files = readers.inventory(readers.read_months(spark, root), "month")
    return files.groupBy("month").agg(F.sum("row_count").alias("row_count"), F.min((F.col("file_size") > 0) & (F.col("row_count") > 0)).alias("files_filled"))


def _text_run(spark, sf, label: str) -> MonthRunner:
    """Months that land as text with broken lines, ingested up to Silver."""
    prepare(spark)
    root = land_text_months(spark, sf, scratch_root(spark, label))
    r = MonthRunner(spark, Tables(root=root), root, Settings(landing_format="csv", landing_header=False))
    r.silver(r.bronze(landing_months(spark, root)))
    return r


def q_quarantine_report(spark, sf):
    """A2/C11: quarantined lines of text landings per month and reason."""
    return quarantine.report(_text_run(spark, sf, "quarantine_report")._read("quarantine"))


def q_quarantine_good_rows(spark, sf):
    """A2/C11: Silver of text landings, of the lines that fit their schema."""
    return _text_run(spark, sf, "quarantine_good")._read("silver").drop(*RUN_DEPENDENT)


def q_rows_per_month(spark, sf):
    """Rows per month of a persisted month table (read-back after the write); one narrow column besides the month is written."""
    i = Inputs(spark, sf)
    path = i.scratch("rows_per_month")
    sinks.write_months(i.silver.select("hvfhs_license_num", "_source_month"), path)
    return profile.group_count(readers.read_table(spark, path), ["_source_month"], "row_count")


def q_schema_drift(spark, sf):
    """Two months land, the later one drifted (a column missing, one new, one retyped); the report names, from the
    landed files of each month, the columns that differ and in how many of its rows they are filled."""
    from tripmart.schemas import drift
    prepare(spark)
    root = scratch_root(spark, "drift")
    a, b = spark.read.parquet(f"{sf}/orders.parquet").agg(*(F.date_format(f("o_orderdate"), "yyyy-MM") for f in (F.min, F.max))).first()
    land_months(spark, sf, root, [a])
    surge = F.when(F.col("trip_time") > 600, F.lit(1.5))
    drifted = bronze_view(spark, sf, [b]).select(*TRIP_SOURCE.names).drop("cbd_congestion_fee").withColumn("surge_fee", surge)
    drifted.withColumn("trip_time", F.col("trip_time").cast("double")).write.parquet(f"{root}/raw/month={b}")
    out = None
    for month in (a, b):
        landed = readers.read_months(spark, root, [month], schema=None, merge_schema=True).drop("month")
        for name, change, expected, actual in drift(TRIP_SOURCE, landed.schema):
            filled = F.count(F.col(name) if actual else F.lit(None)).alias("filled_rows")
            row = landed.agg(filled).select(F.lit(name).alias("column_name"), F.lit(change).alias("change"), F.lit(expected).cast("string").alias("expected_type"),
                                            F.lit(actual).cast("string").alias("actual_type"), "filled_rows", F.lit(month).alias("month"))
            out = row if out is None else out.unionByName(row)
    return out


def q_schema_evolution(spark, sf):
    """The first half of the months lands as declared; in the rest ``surge_fee`` is new and pick-up zones are 64-bit
    (the lookup's 26th orphan beyond 32). A second run that declares both loads these beside the first ones, which stay as they
    are. One row per month, from the tables of both runs."""
    prepare(spark)
    first, months = _runner(spark, sf, "evolution")
    half = len(months) // 2
    zone = F.col("PULocationID").cast("long")
    later = readers.read_months(spark, first.raw, months[half:]).withColumns({
        "PULocationID": F.when(zone == 26, zone + F.lit(2**40)).otherwise(zone),
        "surge_fee": F.when(F.col("trip_time") > 600, F.floor(F.col("trip_time") / 60) * 0.25)})
    with sinks.unsorted_months(spark):  # read by month folder
        later.write.options(**sinks.PARQUET).partitionBy("month").parquet(f"{first.raw}/changed/raw")
    changes = (SchemaChange("surge_fee", T.DoubleType(), months[half]), SchemaChange("PULocationID", T.LongType(), months[half]))
    second = MonthRunner(spark, first.t, f"{first.raw}/changed", Settings(schema_changes=changes), first.lookup_csv)
    for r, some in ((first, months[:half]), (second, months[half:])):
        for stage in (r.bronze, r.silver, r.dimensions, r.fact):
            stage(some)
    month, rows = F.col("_source_month").alias("source_month"), F.count(F.lit(1))
    zones = second._read("silver").groupBy(month).agg(
        F.count_if(F.col("PULocationID") > 2**31).alias("wide_zones"), F.max(F.typeof("PULocationID")).alias("zone_type"))
    fact = second._read("fact")
    facts = fact.groupBy(month).agg(
        rows.alias("fact_rows"), F.count("surge_fee").alias("surge_rows"), F.sum("surge_fee").alias("surge_total"),
        F.count("pickup_location_key").alias("pickup_keys"))
    # on their own, only the keys are shuffled: beside the sums, every key would carry these along
    keys = fact.select(month, "trip_key").distinct().groupBy("source_month").agg(F.count("trip_key").alias("trip_keys"))
    return facts.join(keys, "source_month").join(zones, "source_month")


# ---------------------------------------------------------------------------
# 2.3 / 2.4 silver

def q_silver_trips(spark, sf):
    return Inputs(spark, sf).silver.drop(*RUN_DEPENDENT)


def q_quality_status_distribution(spark, sf):
    return profile.group_count(Inputs(spark, sf).silver, ["overall_quality_status"])


def q_quality_flag_by_month(spark, sf):
    return profile.group_count(Inputs(spark, sf).silver,
                               ["_source_month", "timestamp_quality_flag", "financial_quality_flag"])


def q_anomaly_flag_matrix(spark, sf):
    s = Settings()
    return profile.anomaly_matrix(Inputs(spark, sf).silver, s.extreme_miles, s.extreme_duration_s)


def q_anomaly_flag_matrix_lowered(spark, sf):
    """D9/H13 with thresholds that this fixture's trips exceed."""
    return profile.anomaly_matrix(Inputs(spark, sf).silver, 100.0, 1800)


def q_preview_trip_time_diff(spark, sf, k: int = C.EXTRACT_ROWS):
    """First trips (in a total order) with reported and computed trip time side by side."""
    cols = ["hvfhs_license_num", "request_datetime", "pickup_datetime", "dropoff_datetime", "trip_time",
            "calculated_trip_time_seconds", "difference_seconds"]
    return marts.top_k(profile.trip_time_diff(Inputs(spark, sf).bronze).select(*cols), _total_order(cols), k)


def q_preview_silver(spark, sf, k: int = C.EXTRACT_ROWS):
    i = Inputs(spark, sf)
    return marts.top_k(i.silver.select(*PREVIEW_COLS), _total_order(PREVIEW_COLS), k)


def q_extract_negative_fare(spark, sf):
    return _extract(Inputs(spark, sf).bronze, F.col("base_passenger_fare") < 0, EXTRACT_FARE_COLS, C.EXTRACT_ROWS)


def q_extract_negative_pay(spark, sf):
    return _extract(Inputs(spark, sf).bronze, F.col("driver_pay") < 0, EXTRACT_PAY_COLS, None)


def q_extract_bad_timestamps(spark, sf):
    return _extract(Inputs(spark, sf).bronze, F.col("request_datetime") > F.col("on_scene_datetime"),
                    EXTRACT_TS_COLS, C.EXTRACT_ROWS)


def q_extract_zero_distance(spark, sf):
    return _extract(Inputs(spark, sf).silver, F.col("trip_miles") == 0, EXTRACT_ZERO_COLS, C.EXTRACT_ROWS)


def q_dispatch_bases_month(spark, sf):
    return profile.month_bases(Inputs(spark, sf).silver)


def q_month_slice_by_date(spark, sf, month: str = "1995-03"):
    """Daily-mart rows of one calendar month by a pushable date range."""
    from tripmart.functions.calendar import month_range
    i = Inputs(spark, sf)
    # the mart's date is the trip's pick-up date: trips of other dates are left out before they are aggregated
    fact = i.fact_of("provider").where(month_range("pickup_datetime", month))
    return marts.daily_provider(marts.partials(fact, marts.DAILY_GRAIN), i.dim_date, i.dim_provider).where(month_range("date", month))


# ---------------------------------------------------------------------------
# 2.5 dimensions and keys

def q_dim_location(spark, sf):
    return Inputs(spark, sf).dim_location


def q_dim_provider(spark, sf):
    return dims.dim_provider(Inputs(spark, sf).silver)


def q_dim_date(spark, sf):
    return dims.dim_date_for(Inputs(spark, sf).silver)


def q_dim_date_weekend_counts(spark, sf):
    return profile.group_count(q_dim_date(spark, sf), ["is_weekend"], "day_count")


def q_dim_dispatch(spark, sf):
    return dims.dim_dispatch(Inputs(spark, sf).silver)


def q_dim_surrogate_key(spark, sf):
    return dims.dim_dispatch(Inputs(spark, sf).silver, "surrogate")


def _incremental_dispatch(spark, sf, key_mode: str, union_rebuild: bool = False):
    """Dimension built from the first month, then extended by all later months (which bring new bases)."""
    i = Inputs(spark, sf)
    # only what both batches read: the distinct bases of each month, in one scan
    s = i.materialize(i.silver.select("_source_month", "dispatching_base_num", "originating_base_num").distinct(), "month_bases")
    first = s.agg(F.min("_source_month")).first()[0]
    path = i.scratch("dim_dispatch")
    sinks.rebuild(dims.dim_dispatch(s.where(F.col("_source_month") == first), key_mode), path)
    existing = readers.read_table(spark, path)
    batch2 = s.where(F.col("_source_month") > first)
    if union_rebuild:
        out = i.scratch("dim_dispatch_rebuilt")
        sinks.rebuild(dims.dispatch_union_rebuild(batch2, existing), out)
        return readers.read_table(spark, out)
    sinks.append(dims.dispatch_delta(batch2, existing, key_mode), path)
    return readers.read_table(spark, path)


def q_dim_dispatch_incremental(spark, sf):
    return _incremental_dispatch(spark, sf, "natural")


def q_dim_surrogate_key_incremental(spark, sf):
    return _incremental_dispatch(spark, sf, "surrogate")


def q_dim_dispatch_union_rebuild(spark, sf):
    return _incremental_dispatch(spark, sf, "natural", union_rebuild=True)


def q_trip_key_uniqueness(spark, sf):
    """Duplicate trip-key groups (hash) over the whole fact."""
    f = Inputs(spark, sf).fact_of()
    g = f.groupBy("trip_key").agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.sum("n").alias("trip_rows"), F.count_if(F.col("n") > 1).alias("duplicate_key_groups"))


def q_trip_identity(spark, sf):
    """Duplicates told from collisions, over all trips and two seeded kinds: the last month's trips again, and the first
    month's without drop-off zone once as they are and once with the zone in the other column (the key skips NULLs, so both hash alike)."""
    s = Inputs(spark, sf).silver.select(*TRIP_KEY_COLUMNS, "_source_month")
    first, last = spark.read.parquet(f"{sf}/orders.parquet").agg(*(F.date_format(f("o_orderdate"), "yyyy-MM") for f in (F.min, F.max))).first()
    month, zone, none = F.col("_source_month"), F.col("PULocationID"), F.lit(None).cast("int")
    there, other = (F.struct(zone.alias("pu"), none.alias("do")), F.struct(none.alias("pu"), zone.alias("do")))
    own = F.struct(zone.alias("pu"), F.col("DOLocationID").alias("do"))
    copies = F.when(month == last, F.array(own, own)).when(month == first, F.array(own, there, other)).otherwise(F.array(own))
    seeded = s.select("*", F.explode(copies).alias("z")).withColumns({"PULocationID": F.col("z.pu"), "DOLocationID": F.col("z.do")})
    return identity.report(seeded.withColumn("trip_key", trip_key()).select("trip_key", *TRIP_KEY_COLUMNS))


def q_fact_trip(spark, sf):
    return Inputs(spark, sf).fact.drop(*RUN_DEPENDENT, "trip_key")


def q_fact_trip_copy_keys(spark, sf):
    i = Inputs(spark, sf, Settings(fact_key_mode="copy"))
    return i.fact.drop(*RUN_DEPENDENT, "trip_key")


def q_dim_key_uniqueness(spark, sf):
    i = Inputs(spark, sf)
    parts = [
        profile.key_uniqueness(i.dim_location, "location_key", "dim_location"),
        profile.key_uniqueness(i.dim_provider, "provider_key", "dim_provider"),
        profile.key_uniqueness(i.dim_date, "date_key", "dim_date"),
        profile.key_uniqueness(i.dim_dispatch, "dispatch_key", "dim_dispatch"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_dim_key_uniqueness_with_defects(spark, sf):
    """H9/N19 FAIL paths: each dimension with its smallest key twice and a NULL member."""
    i = Inputs(spark, sf)
    out = None
    for name, key in (("location", "location_key"), ("provider", "provider_key"), ("date", "date_key"), ("dispatch", "dispatch_key")):
        keys = getattr(i, f"dim_{name}").select(key)
        spoilt = keys.unionByName(keys.agg(F.min(key).alias(key))).unionByName(keys.limit(1).select(F.lit(None).cast(keys.schema[0].dataType).alias(key)))
        part = profile.key_uniqueness(spoilt, key, f"dim_{name}")
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------------------
# 2.6 joins / integrity

def q_invalid_pickup_ids(spark, sf):
    i = Inputs(spark, sf)
    return profile.anti_members(i.silver, "PULocationID", location_lookup(spark, sf), "LocationID", "LocationID")


def q_invalid_dropoff_ids(spark, sf):
    i = Inputs(spark, sf)
    return profile.anti_members(i.silver, "DOLocationID", location_lookup(spark, sf), "LocationID", "LocationID")


def q_invalid_dropoff_ids_short_lookup(spark, sf):
    """G6 with a lookup that lacks its first zones, so that drop-off ids are invalid."""
    return profile.anti_members(Inputs(spark, sf).silver, "DOLocationID", location_lookup(spark, sf).where("LocationID >= 3"),
                                "LocationID", "LocationID")


def q_orphan_date_keys_workdays(spark, sf):
    """G7 with a calendar of workdays: the weekend dates of the fact are orphans."""
    i = Inputs(spark, sf)
    return profile.anti_members(i.fact_of(), "date_key", i.dim_date.where(~F.col("is_weekend")), "date_key", "date_key")


def _copy_fact(spark, sf) -> DataFrame:
    return Inputs(spark, sf, Settings(fact_key_mode="copy")).fact


def q_orphan_provider_keys(spark, sf):
    """Copy-key fact against the provider dimension of the KNOWN codes (the unknown code is orphaned)."""
    return profile.anti_members(_copy_fact(spark, sf), "provider_key", dims.dim_provider_known(spark),
                                "provider_key", "provider_key")


def q_orphan_pickup_keys(spark, sf):
    i = Inputs(spark, sf)
    return profile.anti_members(_copy_fact(spark, sf), "pickup_location_key", i.dim_location, "location_key",
                                "pickup_location_key")


def q_orphan_dropoff_keys(spark, sf):
    i = Inputs(spark, sf)
    return profile.anti_members(_copy_fact(spark, sf), "dropoff_location_key", i.dim_location, "location_key",
                                "dropoff_location_key")


def q_orphan_date_keys(spark, sf):
    i = Inputs(spark, sf)
    return profile.anti_members(i.fact_of(), "date_key", i.dim_date, "date_key", "date_key")


def q_bases_in_both_roles(spark, sf):
    return profile.both_roles(Inputs(spark, sf).silver)


# ---------------------------------------------------------------------------
# 2.7 / 2.9 aggregations, sorts

def q_trips_by_provider(spark, sf):
    return profile.group_count(Inputs(spark, sf).fact_of("provider"), ["provider_key"])


def q_trips_by_dispatching_base(spark, sf):
    return profile.group_count(Inputs(spark, sf).silver, ["dispatching_base_num"])


def q_trips_by_originating_base(spark, sf):
    return profile.group_count(Inputs(spark, sf).silver, ["originating_base_num"])


def q_trips_by_date_key(spark, sf):
    return profile.group_count(Inputs(spark, sf).fact_of(), ["date_key"]).orderBy("date_key")


def q_profile_ranges(spark, sf):
    return profile.ranges(Inputs(spark, sf).silver)


def q_profile_time_range(spark, sf):
    return profile.time_range(Inputs(spark, sf).bronze)


def q_profile_locations(spark, sf):
    return profile.locations(Inputs(spark, sf).bronze)


def q_profile_nulls(spark, sf):
    return profile.nulls_wide(Inputs(spark, sf).bronze)


def q_profile_nulls_long(spark, sf):
    return profile.nulls_long(Inputs(spark, sf).silver)


def q_duplicate_business_rows(spark, sf):
    return profile.duplicate_groups(Inputs(spark, sf).silver)


def q_duplicate_business_rows_seeded(spark, sf):
    """H9 on Silver with its last month twice."""
    s = Inputs(spark, sf).silver
    last = s.agg(F.max("_source_month").alias("last_month"))
    again = s.join(F.broadcast(last), F.col("_source_month") == F.col("last_month")).drop("last_month")  # one row
    return profile.duplicate_groups(s.unionByName(again))


def q_summary_timestamp_gap(spark, sf):
    return profile.summary_timestamp_gap(Inputs(spark, sf).bronze)


def q_summary_trip_time_diff(spark, sf):
    return profile.summary_trip_time_diff(Inputs(spark, sf).bronze)


def q_sketch_quantiles(spark, sf):
    """Quantiles from written month sketches; a value depends on the order of rows, so its measured rank is held against the bound."""
    i = Inputs(spark, sf)
    trips = i.materialize(i.silver.select(*sketches.MEASURES, "_source_month"), "sketch_trips")
    by_month = i.materialize(sketches.month_sketches(trips), "month_sketches")
    found = sketches.quantiles(sketches.merged(by_month), [0.05, 0.25, 0.5, 0.75, 0.95, 0.99])
    written = i.materialize(found, "sketch_quantiles")
    return sketches.within_bound(sketches.rank_intervals_of(trips, written)).select("measure", "probability", "value_count", "within_bound")


def q_flag_value_counts(spark, sf):
    return profile.flag_value_counts(Inputs(spark, sf).bronze)


def q_profile_timestamp_order(spark, sf):
    return profile.timestamp_order(Inputs(spark, sf).bronze)


def q_profile_negatives(spark, sf):
    return profile.negatives(Inputs(spark, sf).bronze)


def q_profile_fact_key_nulls(spark, sf):
    """NULL counts of the six fact keys, one aggregate + unpivot."""
    keys = ["date_key", "provider_key", "pickup_location_key", "dropoff_location_key", "originating_base_key",
            "dispatching_base_key"]
    return profile.nulls_long(Inputs(spark, sf).fact, keys)


# ---------------------------------------------------------------------------
# 2.12 marts

def q_gold_daily_provider(spark, sf):
    i = Inputs(spark, sf)
    return marts.daily_provider(marts.partials(i.fact_of("provider"), marts.DAILY_GRAIN), i.dim_date, i.dim_provider)


def q_gold_daily_provider_rounded(spark, sf):
    i = Inputs(spark, sf)
    p = marts.partials(i.fact_of("provider"), marts.DAILY_GRAIN, "calculated_trip_time_seconds")
    return marts.daily_provider(p, i.dim_date, i.dim_provider, rounded=True)


def q_gold_location(spark, sf):
    i = Inputs(spark, sf)
    return marts.location(i.fact_of("location"), i.dim_location)


def q_gold_location_rounded(spark, sf):
    i = Inputs(spark, sf)
    return marts.location(i.fact_of("location"), i.dim_location, rounded=True, duration_col="calculated_trip_time_seconds")


def q_gold_dropoff_location(spark, sf):
    i = Inputs(spark, sf)
    return marts.location(i.fact_of("location"), i.dim_location, role="dropoff")


def q_gold_shared_ride(spark, sf):
    i = Inputs(spark, sf)
    return marts.shared_ride(i.fact_of("provider"), i.dim_provider)


def q_gold_shared_ride_rounded(spark, sf):
    i = Inputs(spark, sf)
    return marts.shared_ride(i.fact_of("provider"), i.dim_provider, rounded=True)


def q_shared_request_match_share(spark, sf):
    return marts.shared_request_match_share(q_gold_shared_ride(spark, sf))


def q_demand_by_day_hour(spark, sf):
    return marts.demand_by_day_hour(Inputs(spark, sf).silver)


def q_measure_correlations(spark, sf):
    return marts.measure_correlations(Inputs(spark, sf).silver)


def q_top_longest_trips(spark, sf):
    s = Inputs(spark, sf).silver.select(*TOP_TRIP_COLS)
    return marts.top_k(s, _total_order(TOP_TRIP_COLS, F.col("trip_time").desc_nulls_last()))


def q_top_farthest_trips(spark, sf):
    s = Inputs(spark, sf).silver.select(*TOP_TRIP_COLS)
    return marts.top_k(s, _total_order(TOP_TRIP_COLS, F.col("trip_miles").desc_nulls_last()))


def q_top_pickup_zones(spark, sf):
    g = q_gold_location(spark, sf)
    return marts.top_k(g, [F.col("total_trips").desc(), F.col("pickup_location_key").asc_nulls_last()])


def q_top_revenue_zones(spark, sf):
    g = q_gold_location(spark, sf)
    return marts.top_k(g, [F.col("total_passenger_fare").desc(), F.col("pickup_location_key").asc_nulls_last()])


# ---------------------------------------------------------------------------
# 2.13 quality

CHECK_MEASURES = ["trip_miles", "trip_time", "base_passenger_fare", "driver_pay", "tips", "customer_wait_seconds",
                  "overall_quality_status", "timestamp_quality_flag", "financial_quality_flag", "shared_request",
                  "shared_match", "_source_month"]
CHECK_KEYS = ["trip_key", "date_key", "provider_key", "pickup_location_key", "dropoff_location_key",
              "dispatching_base_key"]


#: the measures that the checks of the fact read (the others are for marts)
FACT_CHECK_MEASURES = ["timestamp_quality_flag", "financial_quality_flag", "_source_month"]


def _check_silver(i: Inputs, measures: list[str] = CHECK_MEASURES) -> DataFrame:
    """The Silver columns that the checks and marts read, written once: several passes follow."""
    cols = dict.fromkeys([*TRIP_KEY_COLUMNS, "dispatching_base_num", "originating_base_num", *measures])
    written = i.materialize(i.silver.select(*cols), "check_silver")
    i.members = dims.member_values(written).checkpoint(eager=True)  # from the table, not from a second landing join
    return written


def _check_fact(silver: DataFrame, provider: DataFrame, location: DataFrame, dispatch: DataFrame, measures: list[str] = CHECK_MEASURES) -> DataFrame:
    return build_fact(silver, provider, location, dispatch, columns=[*CHECK_KEYS, *measures])


def _dq(i: Inputs, silver: DataFrame, fact: DataFrame, spoil: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """N1-N12 for every month. The fact stays lazy over the written Silver (its lookups are
    broadcast, narrow work); the three marts come from ONE small written partial aggregate.
    ``spoil`` takes rows out of a mart, to seed a defect."""
    parts = i.materialize(marts.partials(fact, marts.PARTIAL_GRAIN), "dq_partials")
    daily, loc, shared = marts.published(parts, i.dim_date, i.dim_provider, i.dim_location)
    if spoil:
        loc, shared = spoil(loc, "location"), spoil(shared, "shared")
    lt, st = quality.mart_totals(loc, shared)
    return quality.with_overall(quality.report(silver, fact, daily, lt, st))


def q_dq_report(spark, sf):
    i = Inputs(spark, sf)
    s = _check_silver(i)
    return _dq(i, s, _check_fact(s, i.dim_provider, i.dim_location, i.dim_dispatch))


def q_dq_report_with_duplicates(spark, sf):
    """N3 FAIL path: every trip loaded twice (Silver and fact both doubled)."""
    i = Inputs(spark, sf)
    s = _check_silver(i)
    doubled = s.unionByName(s)
    return _dq(i, doubled, _check_fact(doubled, i.dim_provider, i.dim_location, i.dim_dispatch))


def q_dq_report_with_defects(spark, sf):
    """FAIL paths of N1-N4, N6, N10 and N11: Silver without its first month, a fact with its last month
    twice and keys of incomplete dimensions (known providers only, the smallest base missing), and
    marts without the largest zone and without the unknown provider."""
    i = Inputs(spark, sf)
    s = _check_silver(i)
    ends = s.agg(F.min("_source_month").alias("a"), F.max("_source_month").alias("b")).first()
    lowest = i.dim_dispatch.agg(F.min("base_num")).first()[0]
    loaded = s.unionByName(s.where(F.col("_source_month") == ends["b"]))
    fact = _check_fact(loaded, dims.dim_provider_known(spark), i.dim_location, i.dim_dispatch.where(F.col("base_num") != lowest))

    def spoil(mart: DataFrame, name: str) -> DataFrame:
        if name == "shared":
            return mart.where(F.col("provider_key").isNotNull())
        top = i.dim_location.agg(F.max("location_key")).first()[0]
        return mart.where(~F.col("pickup_location_key").eqNullSafe(F.lit(top)))

    return _dq(i, s.where(F.col("_source_month") != ends["a"]), fact, spoil)


def q_dq_fact_checks(spark, sf):
    i = Inputs(spark, sf)
    s = _check_silver(i, FACT_CHECK_MEASURES)
    return quality.report(s, _check_fact(s, i.dim_provider, i.dim_location, i.dim_dispatch, FACT_CHECK_MEASURES))


def q_dq_gold_reconciliation(spark, sf):
    r = q_dq_report(spark, sf)
    return r.where(F.col("check_id").isin("N9", "N10", "N11"))


def _spilled(spark, sf) -> tuple[Inputs, DataFrame]:
    """Trips per file month and date, written: the calendar and both sides of the spill come from it."""
    i = Inputs(spark, sf)
    per_day = i.fact_of().groupBy("_source_month", "date_key").agg(F.count(F.lit(1)).alias("total_trips"))
    parts = i.materialize(per_day, "spill_parts")
    days = parts.select(F.to_timestamp(F.col("date_key").cast("string"), "yyyyMMdd").alias("pickup_datetime"))
    return i, quality.spill_rows(parts, dims.dim_date_for(days))


def q_dq_spill_rows(spark, sf):
    """Which dates of a file month's trips lie in another calendar month, from both months' sides."""
    return _spilled(spark, sf)[1]


def q_dq_spill_months(spark, sf):
    """By how many rows N9's two sides differ in each month that trips spill out of or into."""
    return quality.spill_per_month(_spilled(spark, sf)[1])


# ---------------------------------------------------------------------------
# 2.14 orchestration

def _runner(spark, sf, label: str, settings: Settings = Settings()) -> tuple[MonthRunner, list[str]]:
    root = scratch_root(spark, label)
    land_months(spark, sf, root)
    lookup_path = f"{root}/zone_lookup_csv"
    location_lookup(spark, sf).write.option("header", True).csv(lookup_path)
    r = MonthRunner(spark, Tables(root=root), root, settings, lookup_csv=lookup_path)
    return r, landing_months(spark, root)


def q_run_month_report(spark, sf):
    """O1: every landed month through all stages in one batch; the quality report of the run."""
    prepare(spark)
    r, months = _runner(spark, sf, "run_month")
    return r.run(months)


def q_incremental_two_months(spark, sf):
    """O2: back-fill in two batches (first half of the months, then the rest); the daily mart after both."""
    prepare(spark)
    r, months = _runner(spark, sf, "incremental")
    half = len(months) // 2
    r.run(months[:half])
    r.run(months[half:])
    return r.gold_daily()


def q_run_stage_results(spark, sf):
    """What the run did with every month at each month-partitioned stage."""
    prepare(spark)
    r, months = _runner(spark, sf, "stage_results")
    r.run(months)
    return r.results_frame().where(F.col("stage").isin("bronze", "silver", "fact"))


def q_published_gold_location(spark, sf):
    """The written mart table after a run in two batches and a rebuild of a table of another schema."""
    prepare(spark)
    r, months = _runner(spark, sf, "published")
    spark.range(1).write.parquet(r.t.path("gold_location"))
    half = len(months) // 2
    r.run(months[:half])
    r.run(months[half:])
    return r._read("gold_location")


def q_landing_reissue(spark, sf):
    """Skip mode notices changed landing files. After a first run the first month is re-issued without the trips
    of zones 0 to 4, the second gets one more file (its shared requests again) and a file of the third (zones 0 to 12) is taken away;
    the second run loads just these. One row per month: what the second run did and Silver's rows."""
    prepare(spark)
    root = scratch_root(spark, "reissue")
    land_months(spark, sf, root)
    months = landing_months(spark, root)
    raw = readers.read_months(spark, root, months[:3]).checkpoint(eager=True)  # its files are about to be replaced
    zone = F.col("PULocationID")
    third = f"{root}/raw/month={months[2]}"
    lower = raw.where((F.col("month") == months[2]) & (zone < 13)).drop("month").coalesce(1)
    sinks.relay(raw.where((F.col("month") == months[2]) & (zone >= 13)).drop("month"), third)
    others = set(sinks.data_files(spark, third))
    lower.write.mode("append").parquet(third)
    r = MonthRunner(spark, Tables(root=root), root)
    r.silver(r.bronze(months))
    sinks.relay(raw.where((F.col("month") == months[0]) & (zone >= 5)).drop("month"), f"{root}/raw/month={months[0]}")
    raw.where((F.col("month") == months[1]) & (F.col("shared_request_flag") == "Y")).drop("month").write.mode("append").parquet(f"{root}/raw/month={months[1]}")
    sinks.remove_files(spark, set(sinks.data_files(spark, third)) - others)
    again = MonthRunner(spark, Tables(root=root), root)
    again.bronze(months)
    again.silver(months)
    did = again.results_frame().where(F.col("stage") == "silver").select("month", F.col("status").alias("second_run"))
    rows = again._read("silver").groupBy(F.col("_source_month").alias("month")).agg(F.count(F.lit(1)).alias("silver_rows"))
    return did.join(rows, "month")


def q_late_members(spark, sf):
    """A fact built while the zone lookup lacks zones 20 to 24 and the dispatch dimension its smallest base; when
    both arrive, only the months with trips of these are rewritten. Per month: rewritten or not, ids without key before and after, fact rows."""
    prepare(spark)
    r, months = _runner(spark, sf, "late_members")
    zones, lookup = r.lookup_csv, f"{r.raw}/first_zones"
    readers.read_lookup_csv(spark, zones).where("LocationID < 20").write.option("header", True).csv(lookup)
    r.bronze(months)
    r.silver(months)
    r.lookup_csv = lookup
    r.dimensions(months)
    known = r._read("dim_dispatch")
    early = known.where(F.col("base_num") > known.agg(F.min("base_num")).first()[0]).checkpoint(eager=True)
    sinks.rebuild(early, r.t.path("dim_dispatch"))
    r.fact(months)
    before = {m: e.unresolved for m, e in r._entries()["fact"].items()}
    r.lookup_csv = zones
    again = MonthRunner(spark, r.t, r.raw, Settings(load_mode="replace"), lookup_csv=zones)
    again.dimensions(months)
    late = MonthRunner(spark, r.t, r.raw, lookup_csv=zones)
    rewritten = late.resolve_late_members()
    entries = late._entries()["fact"]
    rows = [(m, m in rewritten, before[m], entries[m].unresolved) for m in months]
    told = spark.createDataFrame(rows, "source_month string, rewritten boolean, unresolved_before long, unresolved_after long")
    facts = late._read("fact").groupBy(F.col("_source_month").alias("source_month")).agg(F.count(F.lit(1)).alias("fact_rows"))
    return told.join(facts, "source_month")


def q_idempotent_reload(spark, sf):
    """O3: run all months, then run them again; row counts of every table after the replay."""
    prepare(spark)
    r, months = _runner(spark, sf, "replay")
    r.run(months)
    r.run(months)
    parts = []
    for name in ["bronze", "silver", "fact", "dim_dispatch", "dim_provider", "dim_date", "dim_location"]:
        parts.append(r._read(name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")))
    for name, mart in (("gold_daily_provider", r.gold_daily()), ("gold_location", r.gold_location()),
                       ("gold_shared_ride", r.gold_shared())):
        parts.append(mart.agg(F.lit(name).alias("table_name"), F.sum("total_trips").alias("row_count")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    k[2:]: v for k, v in sorted(globals().items()) if k.startswith("q_") and callable(v)
}
