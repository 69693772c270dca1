"""Trip-shaped landing data derived from the supplied relational tables.

The supplied tables hold no trips, so one trip is derived per
``lineitem JOIN orders`` row with fixed formulas (see FIXTURES.md section 3).
Only the needed columns are scanned; a month filter becomes a range
predicate on ``o_orderdate`` that reaches the Parquet scan before the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.schemas import TRIP_SOURCE
from tripmart.sources.sinks import PARQUET, unsorted_months

LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]


#: text landings are compressed files, as months land by the gigabyte; a file is read by one task, and the clustering by month
#: bounds its rows
TEXT_CODEC = "lz4"


def _plus_seconds(ts: Column, secs: Column) -> Column:
    return F.timestamp_add("SECOND", secs, ts)


def _cents(c: str) -> Column:
    """Two-decimal rate as whole hundredths (0.07 -> 7)."""
    return F.floor(F.col(c) * 100 + 0.5)


def trip_columns() -> dict[str, Column]:
    """The 25 trip columns as expressions over lineitem x orders columns."""
    d = (F.col("l_quantity") * 60 - 90).cast("long")
    request = _plus_seconds(F.col("o_orderdate"), (F.col("l_orderkey") * 37 % 86400))
    pickup_off = F.col("l_partkey") % 900 + (F.col("l_suppkey") % 7) * 30 - 15
    pu = (F.col("o_custkey") % 27).cast("int")
    do = (F.col("l_partkey") % 25).cast("int")
    rf, ls, ln = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    return {
        "hvfhs_license_num": F.concat(F.lit("HV000"), (F.col("l_suppkey") % 5 + 2).cast("string")),
        "dispatching_base_num": F.concat(F.lit("B"), F.lpad((F.col("l_suppkey") % 40).cast("string"), 5, "0")),
        "originating_base_num": F.when(
            F.col("o_orderpriority") != "5-LOW",
            F.concat(F.lit("B"), F.lpad((F.col("o_custkey") % 60).cast("string"), 5, "0")),
        ),
        "request_datetime": request,
        "on_scene_datetime": F.when(F.col("o_orderstatus") != "P", _plus_seconds(request, F.col("l_partkey") % 900 - 20)),
        "pickup_datetime": _plus_seconds(request, pickup_off),
        "dropoff_datetime": _plus_seconds(request, pickup_off + d),
        "PULocationID": pu,
        "DOLocationID": do,
        "trip_miles": _cents("l_discount") * F.col("l_quantity") * 1.25,
        "trip_time": d + ln - 2,
        "base_passenger_fare": F.when((F.col("l_tax") == 0.08) & (ln == 1), -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")),
        "tolls": F.when(ls == "O", F.lit(0.0)).otherwise(_cents("l_tax") * 0.5),
        "bcf": _cents("l_discount") * 0.25,
        "sales_tax": _cents("l_tax") * 0.75,
        "congestion_surcharge": F.when(pu < 10, F.lit(2.75)).otherwise(F.lit(0.0)),
        "airport_fee": F.when(do == 1, F.lit(2.5)).otherwise(F.lit(0.0)),
        "tips": _cents("l_tax") * 0.25,
        "driver_pay": F.when(F.col("l_suppkey") % 50 == 7, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")),
        "cbd_congestion_fee": F.when(pu < 5, F.lit(1.5)).otherwise(F.lit(0.0)),
        "shared_request_flag": F.when(rf == "R", "Y").when(rf == "N", "N"),
        "shared_match_flag": F.when(rf == "A", F.lit(None)).when((rf == "R") & (ls == "F"), "Y").otherwise("N"),
        "access_a_ride_flag": F.when(ln % 3 == 0, "Y").when(ln % 3 == 1, "N").otherwise(" "),
        "wav_request_flag": F.when(ln == 7, "Y").otherwise("N"),
        "wav_match_flag": F.when(ln >= 6, "Y").otherwise("N"),
    }


def _orders(spark: SparkSession, sf_dir: str, months: list[str] | None) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(*ORDERS_COLS)
    if months:
        # One pushable range per month on the order date (file month = order month).
        cond = None
        for m in sorted(set(months)):
            first = F.to_timestamp_ntz(F.lit(f"{m}-01 00:00:00"))
            c = (F.col("o_orderdate") >= first) & (F.col("o_orderdate") < F.timestamp_add("MONTH", F.lit(1), first))
            cond = c if cond is None else cond | c
        o = o.where(cond)
    # formatted once an order, not once a trip
    return o.withColumn("landing_month", F.date_format("o_orderdate", "yyyy-MM"))


def spread(df: DataFrame) -> DataFrame:
    """Round-robin an under-split scan over all cores.

    A single-row-group file is one scan task however large the cluster; when a
    scan has fewer splits than the cluster has cores, one cheap shuffle lets the
    rest of the plan run in parallel. Large inputs (many splits) are untouched.
    """
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - e.g. Spark Connect has no RDD view; leave the plan as is
        return df
    return df.repartition(cores) if splits < cores else df


def _joined(spark: SparkSession, sf_dir: str, months: list[str] | None = None, with_file: bool = False) -> DataFrame:
    """lineitem JOIN orders, the columns that trips are derived from, plus ``landing_month`` ('yyyy-MM' of the order date)."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    extra = [F.col("_metadata.file_path").alias("_source_file")] if with_file else []
    li = spread(li.select(*LINEITEM_COLS, *extra))
    j = li.join(_orders(spark, sf_dir, months), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.drop("o_orderkey")


def _trips(joined: DataFrame, *extra: str) -> DataFrame:
    cols = trip_columns()
    return joined.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in TRIP_SOURCE.fields], "landing_month", *extra)


def landing_trips(spark: SparkSession, sf_dir: str, months: list[str] | None = None, with_file: bool = False) -> DataFrame:
    """Raw trips (25 columns, declared types) plus ``landing_month`` ('yyyy-MM' of the order date)."""
    return _trips(_joined(spark, sf_dir, months, with_file), *(["_source_file"] if with_file else []))


def _by_month(spark: SparkSession, sf_dir: str, months: list[str] | None = None) -> DataFrame:
    """``landing_trips`` clustered by month (few files per month; REBALANCE lets AQE split a hot month). The columns of the
    join are shuffled, not the 25 trip columns derived from them, which are about twice the bytes."""
    return _trips(_joined(spark, sf_dir, months).hint("rebalance", "landing_month"))


def bronze_view(spark: SparkSession, sf_dir: str, months: list[str] | None = None) -> DataFrame:
    """Unpersisted Bronze: landing trips with the three lineage columns."""
    t = landing_trips(spark, sf_dir, months, with_file=True)
    return t.withColumnRenamed("landing_month", "_source_month").withColumn("_ingested_at", F.current_timestamp())


def location_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone-lookup-shaped rows (LocationID, Borough, Zone, service_zone) from nation x region."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    r = spark.read.parquet(f"{sf_dir}/region.parquet")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").cast("int").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.concat(F.lit("SZ"), (F.col("n_nationkey") % 4).cast("string")).alias("service_zone"),
    )


def land_months(spark: SparkSession, sf_dir: str, raw_base: str, months: list[str] | None = None) -> str:
    """Write the landing layout ``{raw_base}/raw/month=yyyy-MM/`` in one distributed job."""
    trips = _by_month(spark, sf_dir, months).withColumnRenamed("landing_month", "month")
    with unsorted_months(spark):
        trips.write.mode("overwrite").options(**PARQUET).partitionBy("month").parquet(f"{raw_base}/raw")
    return raw_base


def land_text_months(spark: SparkSession, sf_dir: str, raw_base: str) -> str:
    """The landing layout as headerless CSV lines, of which a tenth are broken, by the trip time modulo 50:
    1 a trip time that is no number, 2 a pick-up time that is no date, 3 a zone beyond its type and tips that are no number,
    4 a line cut after its twentieth field, 5 a line with a field too many."""
    trips = _by_month(spark, sf_dir)
    k = F.pmod(F.coalesce("trip_time", F.lit(0)), F.lit(50))
    seeded = {"trip_time": (1, "n/a"), "pickup_datetime": (2, "1995-13-45"), "PULocationID": (3, "99999999999"), "tips": (3, "free")}

    def line(names: list[str]) -> Column:
        text = {f.name: F.col(f.name).cast("string") for f in TRIP_SOURCE.fields}
        for name, (at, value) in seeded.items():
            text[name] = F.when(k == at, F.lit(value)).otherwise(text[name])
        times = [f.name for f in TRIP_SOURCE.fields if f.dataType.typeName() == "timestamp_ntz"]
        for name in times:
            text[name] = F.replace(text[name], F.lit(" "), F.lit("T"))
        return F.to_csv(F.struct(*[text[n].alias(n) for n in names]), {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})

    whole = line(TRIP_SOURCE.names)
    value = F.when(k == 4, line(TRIP_SOURCE.names[:20])).when(k == 5, F.concat(whole, F.lit(",more"))).otherwise(whole)
    with unsorted_months(spark):
        trips.select(value.alias("value"), F.col("landing_month").alias("month")).write.mode("overwrite").option("compression", TEXT_CODEC).partitionBy("month").text(f"{raw_base}/raw")
    return raw_base
