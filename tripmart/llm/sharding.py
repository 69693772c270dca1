"""Shards by extendible hashing, in DataFrame functions only.

Every row has a 60-bit hash (MD5 of its id and its text's MD5). A bucket is a prefix of the
hash; bucket ``d`` bits deep splits on bit ``d + 1`` only if its bytes exceed the limit and it
has more than one row. So a row's shard is its shortest prefix whose rows fit.

No row is split one bit at a time: rows are summed into cells of a depth that the total asks
for, all prefixes of the cells are summed from these, and each cell gets its shallowest
fitting prefix. That is the directory: cell -> shard. Rows find their shard by an equi-join
with it. Cells that are still too large are done again, deeper, with their rows alone. Rows
that agree in id and text share all 60 bits; they go on with 60 bits more, from the
hash of their number in the checkpointed list of rows, so a hot group of equal rows splits too.

Defined cases: a null or empty text has no bytes; a null id is hashed like an empty one; a row
of more bytes than the limit is alone in its shard and marked ``oversized``; an empty table
gives no rows; columns other than id and text are only carried where whole rows are returned.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, free

BITS = 60
SHARD_BYTES = 1 << 20


def prefix_hash(*parts: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, BITS // 4), 16, 10).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    return prefix_hash(F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))


def sized_rows(docs: DataFrame, doc_id: str, text: str, number: str | None = None) -> DataFrame:
    """(n, doc_id, doc_bytes, h1, h2): narrow and checkpointed, so that the row numbers behind h2 stay."""
    whole = F.col(text).cast("string")
    n = F.col(number) if number else F.monotonically_increasing_id()
    rows = docs.select(n.alias("n"), F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.octet_length(whole), F.lit(0)).cast("long").alias("doc_bytes"), row_hash(F.col(doc_id).cast("long"), whole).alias("h1"))
    return cut(rows).withColumn("h2", prefix_hash(F.col("h1").cast("string"), F.col("n").cast("string")))


def _prefix(depth: Column) -> list[Column]:
    """The first ``depth`` of the 120 bits of h1 and h2, as two longs."""
    one = F.when(depth >= BITS, F.col("h1")).otherwise(F.call_function("shiftright", F.col("h1"), (F.lit(BITS) - depth).cast("int")))
    two = F.when(depth > BITS, F.call_function("shiftright", F.col("h2"), (F.lit(2 * BITS) - depth).cast("int"))).otherwise(F.lit(0).cast("long"))
    return [one.alias("p1"), two.alias("p2")]


def directory(rows: DataFrame, limit: int, above: int, depth: int) -> DataFrame:
    """(c1, c2, depth, p1, p2, shard_bytes, shard_docs) of every cell ``depth`` bits deep.

    The shard is the shallowest prefix longer than ``above`` bits that fits (null: none does).
    ``above`` is -1 at first; later the cells of a round are the whole of what is looked at.
    """
    cells = rows.select(*_prefix(F.lit(depth)), "doc_bytes").groupBy("p1", "p2").agg(F.sum("doc_bytes").alias("bytes"), F.count(F.lit(1)).alias("docs"))
    cells = cut(cells.select(F.col("p1").alias("c1"), F.col("p2").alias("c2"), "bytes", "docs"))
    ways = cells.withColumn("depth", F.explode(F.sequence(F.lit(above + 1), F.lit(depth)))).select("c1", "c2", "bytes", "docs", "depth", *_shorter(F.col("c1"), F.col("c2"), depth))
    buckets = ways.groupBy("depth", "p1", "p2").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
    fit = buckets.where((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1) | (F.col("depth") == 2 * BITS))
    # the shallowest fitting prefix is the one whose parent does not fit
    parent = fit.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("u1"), F.col("p2").alias("u2"))
    up1 = F.when(F.col("depth") > BITS, F.col("p1")).otherwise(F.call_function("shiftright", F.col("p1"), F.lit(1)))
    up2 = F.when(F.col("depth") > BITS, F.call_function("shiftright", F.col("p2"), F.lit(1))).otherwise(F.lit(0).cast("long"))
    leaves = fit.withColumns({"u1": up1, "u2": up2}).join(parent, ["depth", "u1", "u2"], "left_anti").select("depth", "p1", "p2", "shard_bytes", "shard_docs")
    return ways.select("c1", "c2", "depth", "p1", "p2").join(leaves, ["depth", "p1", "p2"]).select("c1", "c2", "depth", "p1", "p2", "shard_bytes", "shard_docs")


def _shorter(c1: Column, c2: Column, deep: int) -> list[Column]:
    """The prefix of column ``depth`` bits of a cell ``deep`` bits deep."""
    depth = F.col("depth")
    one = F.when(depth >= BITS, c1).otherwise(F.call_function("shiftright", c1, (F.lit(min(deep, BITS)) - depth).cast("int")))
    two = F.when(depth > BITS, F.call_function("shiftright", c2, (F.lit(deep) - depth).cast("int"))).otherwise(F.lit(0).cast("long"))
    return [one.alias("p1"), two.alias("p2")]


def _assigned(docs: DataFrame, limit: int, doc_id: str, text: str, number: str | None = None) -> DataFrame:
    rows = sized_rows(docs, doc_id, text, number)
    total = rows.agg(F.sum("doc_bytes")).first()[0] or 0
    above, done = -1, None
    depth = max(1, math.ceil(math.log2(max(1, total / limit))) + 3)
    while True:
        depth = min(depth, 2 * BITS)
        cells = cut(directory(rows, limit, above, depth))
        keyed = rows.select("n", "doc_id", "doc_bytes", "h1", "h2", *(c.alias(x) for c, x in zip(_prefix(F.lit(depth)), ("c1", "c2"))))
        found = keyed.join(cells, ["c1", "c2"])
        part = found.select("n", "doc_id", "doc_bytes", F.col("depth").alias("local_depth"), _bits().alias("shard"), "shard_bytes", "shard_docs", (F.col("shard_bytes") > limit).alias("oversized"))
        done = part if done is None else done.unionByName(part)
        rows = cut(keyed.join(cells, ["c1", "c2"], "left_anti").select("n", "doc_id", "doc_bytes", "h1", "h2"))
        if depth == 2 * BITS or rows.isEmpty():
            return done
        above, depth = depth, depth + 8


def assign_shards(docs: DataFrame, limit: int = SHARD_BYTES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, doc_bytes, local_depth, shard, shard_bytes, shard_docs, oversized) of every row; ``shard`` is the prefix in bits."""
    return _assigned(docs, limit, doc_id, text).drop("n")


def _bits() -> Column:
    """The prefix as a string of its bits."""
    first = F.when(F.col("depth") == 0, "").otherwise(F.lpad(F.bin("p1"), F.least(F.col("depth"), F.lit(BITS)), "0"))
    return F.concat(first, F.when(F.col("depth") > BITS, F.lpad(F.bin("p2"), F.col("depth") - BITS, "0")).otherwise(""))


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, doc_id: str = "doc_id", text: str = "text", fmt: str = "parquet") -> None:
    """Writes whole rows with one folder per shard; a shard's rows meet in one task, which its byte limit bounds."""
    number, shard = free(docs, "row_number", "shard")
    numbered = cut(docs.withColumn(number, F.monotonically_increasing_id()))
    placed = _assigned(numbered, limit, doc_id, text, number).select(F.col("n").alias(number), F.col("shard").alias(shard))
    numbered.join(placed, number).drop(number).repartition(shard).write.format(fmt).partitionBy(shard).save(path)
