"""Mergeable quantiles (H12): one KLL sketch per month and measure, merged for any set of months.

The reference's ``summary()`` is approximate and reads all rows each time. A sketch of a month is a few kilobytes, however
many trips it has; a new or re-issued month adds or replaces its own sketches, and quantiles over all months come from
merging those instead of from the trips. ``exact_quantiles`` stays the exact way.

The rank of a quantile read from a sketch differs from the wanted one by at most ``rank_error(k)`` of the rows (with
99 % confidence for one quantile; merging does not add to it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASURES = ["trip_miles", "trip_time", "base_passenger_fare", "driver_pay", "customer_wait_seconds"]
K = 400


def rank_error(k: int = K) -> float:
    """Bound of a quantile's rank error as a share of the rows; the sketch's published fit, k = 200 gives 1.33 %."""
    return 2.296 / k**0.9723


def month_sketches(trips: DataFrame, measures: list[str] = MEASURES, month: str = "_source_month", k: int = K) -> DataFrame:
    """(month, measure, sketch): one pass, partial sketches are merged per task, so a task ships one per month and measure.

    NULLs and NaN take no part; a measure without values in a month has a NULL sketch.
    """
    values = {m: F.col(m).cast("double") for m in measures}
    wide = trips.groupBy(month).agg(*[F.kll_sketch_agg_double(F.when(~F.isnan(v), v), F.lit(k)).alias(m) for m, v in values.items()])
    return wide.unpivot([month], measures, "measure", "sketch")


def merged(sketches: DataFrame) -> DataFrame:
    """(measure, sketch) over all months of ``sketches``: reads sketches only, never trips."""
    held = sketches.where(F.col("sketch").isNotNull())
    return held.groupBy("measure").agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(sketches: DataFrame, probs: list[float]) -> DataFrame:
    """(measure, probability, value_count, value) of merged sketches."""
    # the sketch is asked for literal ranks only
    wanted = [F.struct(F.lit(float(p)).alias("probability"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value")) for p in probs]
    n = F.kll_sketch_get_n_double("sketch").alias("value_count")
    return sketches.where(F.kll_sketch_get_n_double("sketch") > 0).select("measure", n, F.explode(F.array(*wanted)).alias("q")).select("measure", "q.probability", "value_count", "q.value")


def rank_intervals_of(trips: DataFrame, found: DataFrame) -> DataFrame:
    """Measures the true ranks: ``found`` plus the shares of the trips' values below and up to each value.

    One pass over the trips; ``found`` (measures x probabilities) is bounded by the call and broadcast.
    """
    measures = [r[0] for r in found.select("measure").distinct().collect()]  # bounded by the measures asked for
    if not measures:
        return found.withColumns({"rank_below": F.lit(None).cast("double"), "rank_upto": F.lit(None).cast("double")})
    long = trips.select(*[F.col(m).cast("double").alias(m) for m in measures]).unpivot([], measures, "measure", "v").where(F.col("v").isNotNull() & ~F.isnan("v"))
    ranks = long.join(F.broadcast(found), "measure").groupBy("measure", "probability").agg(
        (F.count_if(F.col("v") < F.col("value")) / F.count(F.lit(1))).alias("rank_below"), (F.count_if(F.col("v") <= F.col("value")) / F.count(F.lit(1))).alias("rank_upto"))
    return found.join(F.broadcast(ranks), ["measure", "probability"])


def within_bound(ranked: DataFrame, k: int = K) -> DataFrame:
    """Does a rank of the value lie within the error bound of the wanted one? (a repeated value has an interval of ranks)"""
    p, e = F.col("probability"), F.lit(rank_error(k))
    return ranked.withColumn("within_bound", (F.col("rank_below") - e <= p) & (p <= F.col("rank_upto") + e))
