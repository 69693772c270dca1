"""Dimension lookups with a checked broadcast.

A dimension is broadcast only after one small job has proven both its size
(row count under a limit) and the uniqueness of its join key; a repeating key
would fan out fact rows and is refused. Above the limit the join is a plain
shuffle join, which AQE may still turn into a broadcast at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DimensionKeyError(ValueError):
    pass


def profile_dimension(dim: DataFrame, key: str) -> tuple[int, int]:
    """(rows, largest multiplicity of a non-NULL key) in one job."""
    r = (
        dim.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.max(F.when(F.col(key).isNotNull(), F.col("n"))), F.lit(0)).alias("dup"),
        )
        .first()
    )
    return int(r["rows"]), int(r["dup"])


def checked_many(dims: list[tuple[DataFrame, str]], limit_rows: int) -> list[tuple[DataFrame, bool]]:
    """``checked`` for several dimensions with ONE profiling job (keys compared as strings); also says which are broadcast."""
    tagged = None
    for i, (d, key) in enumerate(dims):
        t = d.select(F.lit(i).alias("__dim"), F.col(key).cast("string").alias("__k"))
        tagged = t if tagged is None else tagged.unionByName(t)
    stats = (
        tagged.groupBy("__dim", "__k")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("__dim")
        .agg(F.sum("n").alias("rows"), F.max(F.when(F.col("__k").isNotNull(), F.col("n"))).alias("dup"))
        .collect()
    )
    got = {r["__dim"]: (int(r["rows"] or 0), int(r["dup"] or 0)) for r in stats}
    out = []
    for i, (d, key) in enumerate(dims):
        rows, dup = got.get(i, (0, 0))
        if dup > 1:
            raise DimensionKeyError(f"dimension key {key!r} repeats (max {dup} rows per key)")
        out.append((F.broadcast(d), True) if rows <= limit_rows else (d, False))
    return out


def checked(dim: DataFrame, key: str, limit_rows: int) -> DataFrame:
    """The dimension, broadcast-hinted when its proven size allows it."""
    rows, dup = profile_dimension(dim, key)
    if dup > 1:
        raise DimensionKeyError(f"dimension key {key!r} repeats (max {dup} rows per key)")
    return F.broadcast(dim) if rows <= limit_rows else dim


def lookup(fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str, out: dict[str, str], limit_rows: int,
           verified: bool = False, spread_nulls: bool = False) -> DataFrame:
    """Left lookup of ``dim`` on fact_col = dim_col, adding dim columns renamed by ``out``.

    ``spread_nulls`` is for shuffled lookups on a string key: rows without a key, which match
    nothing, are dealt over many partitions instead of meeting in one.
    """
    d = dim.select(F.col(dim_col).alias("__lk"), *[F.col(src).alias(dst) for src, dst in out.items()])
    d = d if verified else checked(d, "__lk", limit_rows)
    key = fact[fact_col]
    if spread_nulls and dict(fact.dtypes)[fact_col] == "string":
        # a NUL character in front: no key of the dimension looks like that
        key = F.coalesce(key, F.concat(F.lit("\0"), F.pmod(F.xxhash64(*[fact[c] for c in fact.columns]), F.lit(4096)).cast("string")))
    return fact.join(d, key == d["__lk"], "left").drop("__lk")
