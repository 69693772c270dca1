"""Declared schema changes (B9, X15): carried from Bronze to the fact; anything else is refused."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas
from tripmart.config import SchemaChange, Settings, Tables
from tripmart.operators.fact import trip_key, trip_key_ext
from tripmart.plans.monthly import MonthRunner, landing_months
from tripmart.plans.switching import SwitchedRunner
from tripmart.schemas import TRIP_SOURCE, SchemaDriftError
from tripmart.session import scratch_root
from tripmart.sources import readers, sinks
from tripmart.sources.fixture import land_months, location_lookup

from .conftest import SF_SMALL

FEE = ("surge_fee", T.DoubleType())
ZONE = ("PULocationID", T.LongType())


@pytest.fixture(scope="module")
def landed(spark):
    """Four months; the last two have a new column and 64-bit zones. (root, lookup, months)"""
    src = scratch_root(spark, "evolution_src")
    land_months(spark, SF_SMALL, src)
    months = landing_months(spark, src)[:4]
    root = scratch_root(spark, "evolution_landed")
    rows = readers.read_months(spark, src, months)
    rows.where(F.col("month") < months[2]).write.partitionBy("month").parquet(f"{root}/raw")
    later = rows.where(F.col("month") >= months[2]).withColumns({"PULocationID": F.col("PULocationID").cast("long"), "surge_fee": F.col("tips") * 2})
    later.write.mode("append").partitionBy("month").parquet(f"{root}/raw")
    lookup = f"{root}/zones"
    location_lookup(spark, SF_SMALL).write.option("header", True).csv(lookup)
    return root, lookup, months


def changes(since):
    return SchemaChange(*FEE, since), SchemaChange(*ZONE, since)


@pytest.mark.parametrize("change", [
    SchemaChange("trip_time", T.IntegerType()),  # narrower
    SchemaChange("trip_time", T.DoubleType()),  # not every 64-bit number
    SchemaChange("PULocationID", T.StringType()),  # no scan reads one as the other
    SchemaChange("Trip_Miles", T.DoubleType()),  # a name in another case
    SchemaChange("date_key", T.LongType()),
    SchemaChange("_source_file", T.StringType()),
    SchemaChange("__item", T.StringType()),
])
def test_a_change_that_may_lose_values_or_clashes_is_refused(change):
    with pytest.raises(ValueError):
        schemas.evolve(TRIP_SOURCE, (change,))


def test_the_schema_of_a_month():
    some = (SchemaChange("fee", T.FloatType(), "2024-03"), SchemaChange("fee", T.DoubleType(), "2024-05"), SchemaChange(*ZONE, "2024-05"))
    of = lambda m: schemas.evolve(TRIP_SOURCE, some, m)
    assert of("2024-02") == TRIP_SOURCE
    assert of("2024-03").names == [*TRIP_SOURCE.names, "fee"] and of("2024-04")["fee"].dataType == T.FloatType()
    assert of("2024-05")["fee"].dataType == T.DoubleType() and of("2024-05")["PULocationID"].dataType == T.LongType()
    assert schemas.added(some) == {"fee": T.DoubleType()} and schemas.widened(some) == {"PULocationID": T.LongType()}


def test_keys_of_values_that_fit_stay(spark, landed):
    root, _, months = landed
    narrow = readers.read_months(spark, root, months[:1])
    names = [x for x in narrow.columns if x != "month"]
    for wide, cast in (({"PULocationID": T.LongType()}, "long"), ({"PULocationID": T.DoubleType(), "DOLocationID": T.LongType()}, "double")):
        both = narrow.withColumns({"k": trip_key(), "x": trip_key_ext()})
        both = both.withColumns({"PULocationID": F.col("PULocationID").cast(cast), "DOLocationID": F.col("DOLocationID").cast("long" if len(wide) > 1 else "int")})
        counts = both.agg(F.count_if(F.col("k") == trip_key(wide)), F.count_if(F.col("x") == trip_key_ext(wide)), F.count(F.lit(1))).first()
        assert counts[0] == counts[1] == counts[2] > 0
    rows = narrow.select(*names).limit(1)
    beyond = rows.withColumn("PULocationID", F.explode(F.array(*[F.lit(v).cast("long") for v in (1, 2**31, 2**32 + 1, 2**40 + 1)], F.lit(None).cast("long"))))
    assert beyond.select(trip_key({"PULocationID": T.LongType()}).alias("k")).distinct().count() == 5
    parts = rows.withColumn("PULocationID", F.explode(F.array(F.lit(1.0), F.lit(1.5), F.lit(float("nan")))))
    assert parts.select(trip_key({"PULocationID": T.DoubleType()}).alias("k")).distinct().count() == 3


@pytest.mark.parametrize("mode", ["lookup", "copy"])
def test_a_change_is_carried_to_the_fact_in_one_batch_or_two(spark, landed, mode):
    root, lookup, months = landed
    settings = Settings(schema_changes=changes(months[2]), fact_key_mode=mode)
    at_once = MonthRunner(spark, Tables(root=scratch_root(spark, "evolution_once")), root, settings, lookup)
    at_once.run(months)
    t = Tables(root=scratch_root(spark, "evolution_twice"))
    MonthRunner(spark, t, root, Settings(fact_key_mode=mode), lookup).run(months[:2])
    second = MonthRunner(spark, t, root, settings, lookup)
    second.run(months)
    assert {x.month for x in second.results if x.stage == "bronze" and x.status == "skipped"} == set(months[:2])
    for name, own in (("bronze", "PULocationID"), ("silver", "PULocationID"), ("fact", "pickup_location_key")):
        one, two = (r._read(name).drop("_ingested_at", "_source_file") for r in (at_once, second))
        want = T.IntegerType() if name == "fact" and mode == "lookup" else T.LongType()
        assert one.schema[own].dataType == two.schema[own].dataType == want
        assert one.exceptAll(two.select(*one.columns)).count() == 0 == two.select(*one.columns).exceptAll(one).count()
    fees = {r[0]: (r[1], r[2]) for r in second._read("fact").groupBy("_source_month").agg(F.count("surge_fee"), F.count_if(F.col("surge_fee") == F.col("tips") * 2)).collect()}
    rows = sinks.month_rows(second._read("fact"), months)
    assert fees == {m: (0, 0) if m < months[2] else (rows[m], rows[m]) for m in months}
    report = {(r.source_month, r.check_id): r.status for r in second.checks(months).collect()}
    assert all(report[(m, c)] == "PASS" for m in months for c in ("N1", "N2", "N3", "N10", "N11"))


def test_what_is_not_declared_for_the_month_is_refused(spark, landed):
    root, lookup, months = landed

    def load(some, declared):
        MonthRunner(spark, Tables(root=scratch_root(spark, "evolution_refused")), root, Settings(schema_changes=declared), lookup).bronze(some)

    with pytest.raises(SchemaDriftError) as e:  # not declared at all
        load(months[2:], ())
    assert {d[:2] for d in e.value.diffs} == {("surge_fee", "new"), ("PULocationID", "retyped")}
    with pytest.raises(SchemaDriftError) as e:  # declared too early: a month lacks the column
        load(months[:2], changes(months[1]))
    assert {d[:2] for d in e.value.diffs} == {("surge_fee", "missing"), ("PULocationID", "retyped")}
    with pytest.raises(SchemaDriftError) as e:  # declared too late
        load(months[2:3], changes(months[3]))
    with pytest.raises(SchemaDriftError) as e:  # one of two
        load(months[2:], changes(months[2])[:1])
    assert {d[:2] for d in e.value.diffs} == {("PULocationID", "retyped")}


def test_text_landings_of_both_schemas_in_one_batch(spark, landed):
    root, lookup, months = landed
    text = scratch_root(spark, "evolution_text")
    stamps = {f.name: F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss") for f in TRIP_SOURCE.fields if f.dataType == T.TimestampNTZType()}
    for m in (months[1], months[2]):
        rows = spark.read.parquet(f"{root}/raw/month={m}").withColumns(stamps)
        rows = rows.withColumn("tips", F.when(F.col("trip_time") % 7 == 0, F.lit("free")).otherwise(F.col("tips").cast("string")))
        rows.coalesce(1).write.option("header", True).csv(f"{text}/raw/month={m}")
    settings = Settings(landing_format="csv", schema_changes=changes(months[2]), required_columns=("surge_fee",))
    r = MonthRunner(spark, Tables(root=text), text, settings, lookup)
    r.silver(r.bronze(months[1:3]))
    source = {m: spark.read.parquet(f"{root}/raw/month={m}") for m in months[1:3]}
    bad = {m: df.where("trip_time % 7 = 0").count() for m, df in source.items()}
    assert sinks.month_rows(r._read("quarantine"), months) == bad
    assert sinks.month_rows(r._read("silver"), months) == {m: df.count() - bad[m] for m, df in source.items()}
    assert r._read("quarantine").where(F.array_contains("reasons", "type:tips")).count() == sum(bad.values())
    fees = dict(r._read("silver").groupBy("_source_month").agg(F.count("surge_fee")).collect())
    assert fees == {months[1]: 0, months[2]: source[months[2]].count() - bad[months[2]]}


def test_named_tables_take_new_columns_but_no_other_types(spark, landed):
    root, lookup, months = landed
    spark.sql("CREATE DATABASE IF NOT EXISTS evolving")
    try:
        t = Tables(database="evolving")
        MonthRunner(spark, t, root, Settings(), lookup).run(months[:2])
        with pytest.raises(ValueError, match="PULocationID"):
            MonthRunner(spark, t, root, Settings(schema_changes=changes(months[2])), lookup).bronze(months[2:])
        assert sinks.month_folders(spark, t.path("bronze")) == months[:2]
        narrow = scratch_root(spark, "evolution_named")
        rows = readers.read_months(spark, root, months[2:], schema=None).withColumn("PULocationID", F.col("PULocationID").cast("int"))
        rows.write.partitionBy("month").parquet(f"{narrow}/raw")
        r = MonthRunner(spark, t, narrow, Settings(schema_changes=changes(months[2])[:1]), lookup)
        r.run(months[2:])
        fees = dict(r._read("fact").groupBy("_source_month").agg(F.count("surge_fee")).collect())
        assert [fees[m] > 0 for m in months] == [False, False, True, True]
    finally:
        spark.sql("DROP DATABASE evolving CASCADE")


def test_views_of_switched_runs_show_the_new_column(spark, landed):
    root, lookup, months = landed
    try:
        t = Tables(database="evolving_live")
        SwitchedRunner(spark, t, root, Settings(), lookup).run(months[:2])
        narrow = scratch_root(spark, "evolution_live")
        rows = readers.read_months(spark, root, months[2:], schema=None).withColumn("PULocationID", F.col("PULocationID").cast("int"))
        rows.write.partitionBy("month").parquet(f"{narrow}/raw")
        SwitchedRunner(spark, t, narrow, Settings(schema_changes=changes(months[2])[:1]), lookup).run(months[2:])
        fees = dict(spark.table("evolving_live.fact_trip").groupBy("_source_month").agg(F.count("surge_fee")).collect())
        assert [fees[m] > 0 for m in months] == [False, False, True, True]
    finally:
        spark.sql("DROP DATABASE IF EXISTS evolving_live CASCADE")
