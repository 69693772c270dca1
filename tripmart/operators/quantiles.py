"""Exact quantiles without a single-task buffer.

``percentile`` merges a value -> count map of the whole column in one final
task. Here the work stays distributed: counts per distinct value (map-side
combined), range partitioning by (group, value), a running count inside each
range partition, and per-group partition offsets from one row per partition
(broadcast). Each value then knows its rank interval [lo, lo + n); the few
rows covering the wanted ranks are interpolated linearly (``quantile_cont``'s
rule): pos = p (N - 1), result = v[floor] + (pos - floor) (v[ceil] - v[floor]).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.session import shared_dir


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, v, n) for several same-typed columns from ONE scan (unpivot + map-side combined count)."""
    long = df.select(*cols).unpivot([], cols, "column_name", "v").where(F.col("v").isNotNull())
    return long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))


def rank_intervals(counts: DataFrame, partitions: int | None = None) -> DataFrame:
    """(column_name, v, n, lo, total) from value counts: first 0-based rank of each value and the column's total."""
    n_parts = partitions or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared_dir(counts.sparkSession)
    # both branches below must see ONE partitioning: its bounds are sampled, so it is evaluated once
    parted = counts.repartitionByRange(n_parts, "column_name", "v").withColumn("__p", F.spark_partition_id()).checkpoint(eager=True)
    running = parted.withColumn(
        "__cum",
        F.sum("n").over(Window.partitionBy("__p", "column_name").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
    # one row per (range partition, column): a proven bound for the broadcast
    sizes = parted.groupBy("column_name", "__p").agg(F.sum("n").alias("__size"))
    w = Window.partitionBy("column_name")
    offsets = sizes.select(
        "column_name", "__p",
        F.coalesce(F.sum("__size").over(w.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("__off"),
        F.sum("__size").over(w).alias("total"),
    )
    return running.join(F.broadcast(offsets), ["column_name", "__p"]).select(
        "column_name", "v", "n", (F.col("__off") + F.col("__cum") - F.col("n")).alias("lo"), "total")


def quantiles_from_counts(counts: DataFrame, probs: list[float]) -> DataFrame:
    """(column_name, p_index, value) for each column and probability."""
    iv = rank_intervals(counts)
    hits = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("total") - 1)
        for side, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            hits.append(F.when((rank >= F.col("lo")) & (rank < F.col("lo") + F.col("n")),
                               F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"),
                                        F.col("v").cast("double").alias("v"), (pos - F.floor(pos)).alias("d"))))
    picked = iv.select("column_name", F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("h"))
    per_p = picked.groupBy("column_name", F.col("h.i").alias("p_index")).agg(
        F.max(F.when(F.col("h.side") == "lo", F.col("h.v"))).alias("a"),
        F.max(F.when(F.col("h.side") == "hi", F.col("h.v"))).alias("b"),
        F.max("h.d").alias("d"),
    )
    return per_p.select("column_name", "p_index", (F.col("a") + F.col("d") * (F.col("b") - F.col("a"))).alias("value"))


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> DataFrame:
    """One row with column q{i} (double) per probability; NULL when the column has no values."""
    q = quantiles_from_counts(value_counts(df, [col]), probs)
    return q.agg(*[F.max(F.when(F.col("p_index") == i, F.col("value"))).alias(f"q{i}") for i in range(len(probs))])
