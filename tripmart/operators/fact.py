"""Silver -> fact_trip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.config import Settings
from tripmart.functions.calendar import date_key
from tripmart.operators.lookup import checked_many, lookup
from tripmart.schemas import FACT_COLUMNS, TRIP_KEY_COLUMNS, TRIP_SOURCE, added, widened


RANGES = {"byte": (-(2**7), 2**7 - 1), "short": (-(2**15), 2**15 - 1), "integer": (-(2**31), 2**31 - 1)}


def _identity(name: str, wide: dict[str, T.DataType]) -> list[F.Column]:
    """A column's inputs to the trip key. A widened one is hashed as its first type where the value fits that, else as
    the wide one; NULL inputs are skipped, so a trip keeps the key that it had before the change."""
    if name not in wide:
        return [F.col(name)]
    kind = TRIP_SOURCE[name].dataType
    if kind.typeName() in RANGES:  # compared, not tried: a cast that fails raises, and catches, an error for every such row
        first = F.when(F.col(name).between(*(F.lit(v).cast(wide[name]) for v in RANGES[kind.typeName()])), F.col(name).cast(kind))
    else:
        first = F.col(name).try_cast(kind)
    fits = F.coalesce(first.cast(wide[name]) == F.col(name), F.lit(False))
    return [F.when(fits, first), F.when(~fits, F.col(name))]


def trip_key(wide: dict[str, T.DataType] | None = None) -> F.Column:
    """xxhash64 over the ten natural-identity columns (NULL inputs are skipped, X14); ``wide``: those of a widened type."""
    return F.xxhash64(*[x for c in TRIP_KEY_COLUMNS for x in _identity(c, wide or {})])


def trip_key_ext(wide: dict[str, T.DataType] | None = None) -> F.Column:
    """Second, independent 64-bit hash of the same ten columns (xxhash64 of the columns in reverse order,
    with a constant prefix so it is not a permutation-free function of the first key)."""
    return F.xxhash64(F.lit("tripmart-ext"), *[x for c in reversed(TRIP_KEY_COLUMNS) for x in _identity(c, wide or {})])


def build_fact(silver: DataFrame, provider: DataFrame | None, location: DataFrame | None,
               dispatch: DataFrame | None, settings: Settings = Settings(), columns: list[str] | None = None,
               unresolved: str | None = None) -> DataFrame:
    """five left lookups (provider, pickup/dropoff location, dispatching/originating base).

    Each dimension is size- and uniqueness-checked once, then broadcast, so the
    fact side is never shuffled; rows are never dropped or multiplied. A dimension
    that is not given is not looked up, and its key columns are left out: a mart
    asks only for the keys it groups by. ``columns`` limits the output (and so what ``silver``
    must hold) to some fact columns. ``unresolved`` names a helper column with the number of the row's
    ids that no dimension has (ids that are there, but whose key is NULL). Source columns that
    ``settings.schema_changes`` add follow the fact's own.
    """
    wide = widened(settings.schema_changes)
    f = silver.withColumns({"trip_key": trip_key(wide), "date_key": date_key("pickup_datetime")})
    cols = columns or [*FACT_COLUMNS, *added(settings.schema_changes)]
    if settings.wide_trip_key:
        # 64-bit keys collide by the birthday bound at ~1e10 rows; two independent hashes do not
        f = f.withColumn("trip_key_ext", trip_key_ext(wide))
        cols = ["trip_key", "trip_key_ext", *[c for c in cols if c != "trip_key"]]
    lim = settings.broadcast_limit_rows
    if settings.fact_key_mode == "copy":
        # direct key copy (raw ids as keys), no lookups.
        f = f.withColumns(
            {
                "provider_key": F.col("hvfhs_license_num"),
                "pickup_location_key": F.col("PULocationID").cast(wide.get("PULocationID", T.IntegerType())),
                "dropoff_location_key": F.col("DOLocationID").cast(wide.get("DOLocationID", T.IntegerType())),
                "dispatching_base_key": F.col("dispatching_base_num"),
                "originating_base_key": F.col("originating_base_num"),
            }
        )
        return f.select(*cols, *([F.lit(0).alias(unresolved)] if unresolved else []))
    looked_up = [
        (provider, "provider_code", "provider_key", {"hvfhs_license_num": "provider_key"}),
        (location, "location_id", "location_key", {"PULocationID": "pickup_location_key", "DOLocationID": "dropoff_location_key"}),
        (dispatch, "base_num", "dispatch_key",
         {"dispatching_base_num": "dispatching_base_key", "originating_base_num": "originating_base_key"}),
    ]
    given = [x for x in looked_up if x[0] is not None]
    sides = checked_many([(d.select(code, key), code) for d, code, key, _ in given], lim) if given else []
    for (side, broadcast), (_, code, key, columns) in zip(sides, given):
        for fact_col, out in columns.items():
            f = lookup(f, side, fact_col, code, {key: out}, lim, verified=True, spread_nulls=not broadcast)
    left_out = {out for d, _, _, columns in looked_up if d is None for out in columns.values()}
    extra = []
    if unresolved:
        pairs = [x for d, _, _, columns in looked_up if d is not None for x in columns.items()]
        missing = [(F.col(i).isNotNull() & F.col(key).isNull()).cast("int") for i, key in pairs]
        extra = [sum(missing, F.lit(0)).alias(unresolved)]
    return f.select(*[c for c in cols if c not in left_out], *extra)
