"""Declared schemas per table, the schema-drift check and declared schema changes.

A change that is not declared is refused. Declared ones are additive: a new nullable column, or a type that holds every
value of the old one. Months before ``since`` must still land as they did, later ones as changed. The tables need no
rewrite: months written before a change are read with the changed schema (NULL, or the value as the wider type).
"""

from __future__ import annotations

from pyspark.sql import types as T

from tripmart.config import LINEAGE_COLUMNS, SchemaChange

S, TS, L, I, D, B = T.StringType(), T.TimestampNTZType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()

# The 25-column monthly trip file.
TRIP_SOURCE = T.StructType(
    [
        T.StructField("hvfhs_license_num", S),
        T.StructField("dispatching_base_num", S),
        T.StructField("originating_base_num", S),
        T.StructField("request_datetime", TS),
        T.StructField("on_scene_datetime", TS),
        T.StructField("pickup_datetime", TS),
        T.StructField("dropoff_datetime", TS),
        T.StructField("PULocationID", I),
        T.StructField("DOLocationID", I),
        T.StructField("trip_miles", D),
        T.StructField("trip_time", L),
        T.StructField("base_passenger_fare", D),
        T.StructField("tolls", D),
        T.StructField("bcf", D),
        T.StructField("sales_tax", D),
        T.StructField("congestion_surcharge", D),
        T.StructField("airport_fee", D),
        T.StructField("tips", D),
        T.StructField("driver_pay", D),
        T.StructField("cbd_congestion_fee", D),
        T.StructField("shared_request_flag", S),
        T.StructField("shared_match_flag", S),
        T.StructField("access_a_ride_flag", S),
        T.StructField("wav_request_flag", S),
        T.StructField("wav_match_flag", S),
    ]
)

SOURCE_MEASURES = [f.name for f in TRIP_SOURCE.fields[:20]]

# Column names and order of Silver, fact and trip identity must equal the reference's.
SILVER_COLUMNS = SOURCE_MEASURES + [
    "shared_request",
    "shared_match",
    "access_a_ride",
    "wav_request",
    "wav_match",
    "customer_wait_seconds",
    "driver_response_seconds",
    "calculated_trip_time_seconds",
    "trip_time_consistent",
    "timestamp_quality_flag",
    "financial_quality_flag",
    "overall_quality_status",
    *LINEAGE_COLUMNS,
]

FACT_COLUMNS = [
    "trip_key",
    "date_key",
    "provider_key",
    "pickup_location_key",
    "dropoff_location_key",
    "dispatching_base_key",
    "originating_base_key",
    "request_datetime",
    "on_scene_datetime",
    "pickup_datetime",
    "dropoff_datetime",
    "trip_miles",
    "trip_time",
    "calculated_trip_time_seconds",
    "base_passenger_fare",
    "tolls",
    "bcf",
    "sales_tax",
    "congestion_surcharge",
    "airport_fee",
    "tips",
    "driver_pay",
    "cbd_congestion_fee",
    "shared_request",
    "shared_match",
    "access_a_ride",
    "wav_request",
    "wav_match",
    "customer_wait_seconds",
    "driver_response_seconds",
    "trip_time_consistent",
    "timestamp_quality_flag",
    "financial_quality_flag",
    "overall_quality_status",
    *LINEAGE_COLUMNS,
]

# Columns of the natural trip identity hashed into trip_key.
TRIP_KEY_COLUMNS = [
    "hvfhs_license_num",
    "request_datetime",
    "pickup_datetime",
    "dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_miles",
    "trip_time",
    "base_passenger_fare",
    "driver_pay",
]

# 25 business columns used by the duplicate-row profile (H9).
BUSINESS_COLUMNS = SOURCE_MEASURES + ["shared_request", "shared_match", "access_a_ride", "wav_request", "wav_match"]

LOCATION_LOOKUP = T.StructType(
    [
        T.StructField("LocationID", I),
        T.StructField("Borough", S),
        T.StructField("Zone", S),
        T.StructField("service_zone", S),
    ]
)


# Types by the wider types that hold each of their values and that a Parquet scan reads their files as.
WIDER = {"tinyint": ("smallint", "int", "bigint", "double"), "smallint": ("int", "bigint", "double"), "int": ("bigint", "double"), "float": ("double",)}
# Names that an added column cannot take, whatever their case.
TAKEN = {c.lower() for c in [*SILVER_COLUMNS, *FACT_COLUMNS, *LINEAGE_COLUMNS, "trip_key_ext", "month"]}


def evolve(declared: T.StructType, changes: tuple[SchemaChange, ...], month: str | None = None) -> T.StructType:
    """The schema with the changes in force in ``month`` (all, if None), in the order of their months; new columns come last.

    A change that is no addition and no wider type, or an addition under a name that the tables use, is a ValueError.
    """
    types = {f.name: f.dataType for f in declared.fields}
    for c in sorted(changes, key=lambda c: c.since):
        if month is not None and c.since > month:
            continue
        old = types.get(c.column)
        if old is None and (c.column.lower() in TAKEN or c.column.lower() in {n.lower() for n in types} or c.column.startswith("_")):
            raise ValueError(f"column {c.column} cannot be added: the name is in use")
        if old not in (None, c.type) and c.type.simpleString() not in WIDER.get(old.simpleString(), ()):
            raise ValueError(f"column {c.column} cannot go from {old.simpleString()} to {c.type.simpleString()}: values may be lost")
        types[c.column] = c.type
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def added(changes: tuple[SchemaChange, ...]) -> dict[str, T.DataType]:
    """Columns that the changes add to the source, with their last types."""
    return {f.name: f.dataType for f in evolve(TRIP_SOURCE, changes).fields if f.name not in TRIP_SOURCE.names}


def widened(changes: tuple[SchemaChange, ...]) -> dict[str, T.DataType]:
    """Columns of the source whose type the changes widen, with their last types."""
    return {f.name: f.dataType for f in evolve(TRIP_SOURCE, changes).fields if f.name in TRIP_SOURCE.names and f.dataType != TRIP_SOURCE[f.name].dataType}


def carried(table: T.StructType, more: dict[str, T.DataType], wide: dict[str, T.DataType]) -> T.StructType:
    """The schema to read a month table with, whichever of its files it was taken from: added columns and last types."""
    last = wide | more
    own = [T.StructField(f.name, last.get(f.name, f.dataType)) for f in table.fields]
    return T.StructType(own + [T.StructField(n, t) for n, t in more.items() if n not in table.names])


def drift(expected: T.StructType, actual: T.StructType, ignore: tuple[str, ...] = LINEAGE_COLUMNS) -> list[tuple[str, str, str, str]]:
    """Differences between two schemas by name and type, lineage columns ignored.

    Returns (column, kind, expected_type, actual_type) with kind in
    missing / new / retyped. Runs on the driver over schema metadata only.
    """
    exp = {f.name: f.dataType.simpleString() for f in expected.fields if f.name not in ignore}
    act = {f.name: f.dataType.simpleString() for f in actual.fields if f.name not in ignore}
    out = []
    for name in sorted(exp.keys() - act.keys()):
        out.append((name, "missing", exp[name], None))
    for name in sorted(act.keys() - exp.keys()):
        out.append((name, "new", None, act[name]))
    for name in sorted(exp.keys() & act.keys()):
        if exp[name] != act[name]:
            out.append((name, "retyped", exp[name], act[name]))
    return out


class SchemaDriftError(ValueError):
    def __init__(self, diffs):
        self.diffs = diffs
        missing = sorted(d[0] for d in diffs if d[1] == "missing")
        new = sorted(d[0] for d in diffs if d[1] == "new")
        retyped = sorted(d[0] for d in diffs if d[1] == "retyped")
        super().__init__(
            "Source schema does not match the declared schema. "
            f"Missing columns: {missing}; new columns: {new}; retyped columns: {retyped}"
        )
