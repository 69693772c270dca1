"""Connected components by alternating large-star and small-star rounds.

Each round is a minimum per node (map-side combined) and an equi-join of the edges with
these minima, so a hub of any degree is never gathered in one task: the join keeps no
state per key and adaptive execution can split it. Edges are checkpointed each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, splittable


def _mark(edges: DataFrame) -> tuple[int, int]:
    """Count and order-free checksum of a set of edges."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"] or 0


def star_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node that has a link to another; root is the smallest node of its component.

    Nodes are longs. Null ends, self-links and repeated links are ignored; no links give no rows.
    """
    now = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col("u") > F.col("v"))).distinct()
    now = cut(now)
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(splittable(low), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(splittable(low), "u")
        small = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        after = cut(small.distinct())
        done, now = mark, after
        mark = _mark(now)
        if mark == done:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
