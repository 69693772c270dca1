"""Trip identity (X14, N3): what a repeated trip key means.

``trip_key`` hashes ten columns to 64 bits and skips NULLs, so two different trips may share one (a collision) and one
trip may be there twice (a duplicate). Only keys seen more than once are looked at again: the first aggregate shuffles
keys alone, combined per task; the ten columns are shuffled just for the rows of repeated keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.schemas import TRIP_KEY_COLUMNS

DUPLICATE, COLLISION, BOTH = "duplicate", "collision", "both"


def repeated_keys(trips: DataFrame, key: str = "trip_key") -> DataFrame:
    """Keys of more than one row, with their number of rows."""
    return trips.groupBy(key).agg(F.count(F.lit(1)).alias("key_rows")).where(F.col("key_rows") > 1)


def identities(trips: DataFrame, key: str = "trip_key", columns: list[str] = TRIP_KEY_COLUMNS) -> DataFrame:
    """Every different trip behind a repeated key, compared by the columns themselves (two NULLs are equal), and its rows."""
    again = repeated_keys(trips, key).select(key)
    return trips.select(key, *columns).join(again, key, "left_semi").groupBy(key, *columns).agg(F.count(F.lit(1)).alias("identity_rows"))


def verdicts(trips: DataFrame, key: str = "trip_key", columns: list[str] = TRIP_KEY_COLUMNS) -> DataFrame:
    """One row per repeated key: different trips behind it, its rows, and what it is.

    ``duplicate``: one trip several times; ``collision``: different trips, each once; ``both``: different trips, one of them repeated.
    """
    per_key = identities(trips, key, columns).groupBy(key).agg(F.count(F.lit(1)).alias("trips"), F.sum("identity_rows").alias("key_rows"))
    kind = F.when(F.col("trips") == 1, DUPLICATE).when(F.col("trips") == F.col("key_rows"), COLLISION).otherwise(BOTH)
    return per_key.withColumn("verdict", kind)


def report(trips: DataFrame, key: str = "trip_key", columns: list[str] = TRIP_KEY_COLUMNS) -> DataFrame:
    """Keys, different trips and rows per verdict, and the rows too many: those that a load without duplicates would not have."""
    return verdicts(trips, key, columns).groupBy("verdict").agg(
        F.count(F.lit(1)).alias("key_count"), F.sum("trips").alias("trip_count"), F.sum("key_rows").alias("row_count"),
        F.sum(F.col("key_rows") - F.col("trips")).alias("surplus_rows"))
