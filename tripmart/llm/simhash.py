"""SimHash near-duplicates by tiled exact comparison.

1. Fingerprints: one pass over the texts (XXH64 of word shingles, bit majorities in numpy).
2. Equal fingerprints become one node. Nodes are dealt into tiles of about ``tile_rows``
   fingerprints that share a population count; within a count the tile is a hash, so no
   tile depends on how the copies are spread.
3. Two fingerprints at distance d differ by d at most in their population counts, so only
   tiles whose counts differ by the radius or less meet. Each pair of tiles is one row of
   an equi-join on the pair's key and one numpy task: both tiles are cut into blocks sorted
   by the counts of their bytes, a block pair is skipped if its count boxes are further
   apart than the radius, and the rest is compared by exclusive-or and bit counts.
4. A tile pair returns a spanning forest of its links (no more than one row per
   fingerprint), never all pairs; distributed components join the forests.

Comparison work grows with the square of the distinct fingerprints, as the method has it;
memory and rows moved per task do not.

Defined cases: null and empty texts have no words and the fingerprint zero, which links
like any other; texts of fewer words than a shingle are one shingle; every input row gives
one row (repeated ids included); a null id gets a component like any row, but names one
only if its component has no other id (then null); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_binary, cut, free, map_batches, same, slices, splittable
from .components import star_components

SHINGLE_WORDS, SEED, RADIUS = 4, 42, 4
TILE_ROWS = 32768
#: pairs of tiles that one task compares, once there are more than a few thousand
TASK_PAIRS = 16
BLOCK_ROWS = 512


def fingerprint(raw: bytes, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a text's lower-cased word shingles, repeats included."""
    words = raw.lower().split()  # bytes: A-Z only, six ASCII separators only
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(begins[at : at + (1 << 16)].tolist(), last[at : at + (1 << 16)].tolist())], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def row_key(doc_id: Column, text: Column) -> Column:
    """Tells rows apart that share an id; equal only for rows that agree in id and text."""
    return F.xxhash64(doc_id, text)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, row_key, fp): fp is the fingerprint's bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.array([fingerprint(x or b"", shingle, seed) for x in as_binary(batch.column("text"))], np.uint64)
            yield pa.record_batch([batch.column("doc_id"), batch.column("row_key"), pa.array(found.view(np.int64))], names=["doc_id", "row_key", "fp"])

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(named.withColumn("row_key", row_key(F.col("doc_id"), F.col("text"))), run, "doc_id long, row_key long, fp long")


def _byte_counts(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint8).reshape(-1, 8)).astype(np.int16)


def _blocks(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The fingerprints in k-d order of their byte counts, and low and high counts of each block."""
    counts = _byte_counts(x)
    order, todo = np.arange(len(x)), [(0, len(x), 0)]
    while todo:  # halve on one byte's count after the other until blocks are small
        a, b, axis = todo.pop()
        if b - a <= BLOCK_ROWS:
            continue
        part = order[a:b]
        mid = (b - a) // 2
        order[a:b] = part[np.argpartition(counts[part, axis], mid)]
        todo += [(a, a + mid, (axis + 1) % 8), (a + mid, b, (axis + 1) % 8)]
    x, counts = x[order], counts[order]
    cuts = range(0, len(x), BLOCK_ROWS)
    return x, np.array([counts[i : i + BLOCK_ROWS].min(axis=0) for i in cuts]), np.array([counts[i : i + BLOCK_ROWS].max(axis=0) for i in cuts])


class _Forest:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def _join_block(forest: _Forest, near: np.ndarray, a: int, b: int) -> None:
    """Joins the links of one block pair; dense blocks spread from row to row instead of visiting each link."""
    if np.count_nonzero(near) <= 2 * BLOCK_ROWS:
        for i, j in zip(*np.nonzero(near)):
            forest.join(a + int(i), b + int(j))
        return
    left = near.any(axis=1)
    while left.any():
        first = int(np.argmax(left))
        rows, cols = np.zeros(near.shape[0], bool), np.zeros(near.shape[1], bool)
        rows[first], fresh = True, np.array([first])
        while len(fresh):
            reach = near[fresh].any(axis=0) & ~cols
            cols |= reach
            new = near[:, reach].any(axis=1) & ~rows if reach.any() else np.zeros_like(rows)
            rows |= new
            fresh = np.flatnonzero(new)
        left &= ~rows
        for i in np.flatnonzero(rows):
            forest.join(a + first, a + int(i))
        for j in np.flatnonzero(cols):
            forest.join(a + first, b + int(j))


def tile_links(one: np.ndarray, two: np.ndarray | None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of all links within ``radius`` between two tiles (or within one, if ``two`` is None)."""
    x, x_low, x_high = _blocks(one)
    y, y_low, y_high = (x, x_low, x_high) if two is None else _blocks(two)
    shift = 0 if two is None else len(x)
    nodes = x if two is None else np.concatenate((x, y))
    forest = _Forest(len(nodes))
    for i in range(len(x_low)):
        gap = np.maximum(0, np.maximum(x_low[i] - y_high, y_low - x_high[i])).sum(axis=1)
        block = x[i * BLOCK_ROWS : (i + 1) * BLOCK_ROWS, None]
        for j in np.flatnonzero(gap <= radius):
            if two is None and j < i:
                continue
            near = np.bitwise_count(block ^ y[None, j * BLOCK_ROWS : (j + 1) * BLOCK_ROWS]) <= radius
            if two is None and i == j:
                np.fill_diagonal(near, False)
            if near.any():
                _join_block(forest, near, i * BLOCK_ROWS, shift + int(j) * BLOCK_ROWS)
    roots = np.array([forest.find(k) for k in range(len(nodes))], np.int64)
    linked = np.flatnonzero(roots != np.arange(len(nodes)))
    return nodes[linked], nodes[roots[linked]]


def links(nodes: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(u, v) forest edges that connect exactly the fingerprints of column ``fp`` (distinct longs) within ``radius``."""
    classed = nodes.select("fp", F.bit_count("fp").alias("ones"))
    sizes = {r["ones"]: -(-r["count"] // tile_rows) for r in classed.groupBy("ones").count().collect()}  # 65 counts at most
    if not sizes:
        return nodes.sparkSession.createDataFrame([], "u long, v long")
    n_tiles = F.create_map(*(F.lit(x) for kv in sizes.items() for x in kv))
    n_pairs = sum(n * sizes.get(c + d, 0) for c, n in sizes.items() for d in range(radius + 1))
    n_tasks = max(min(n_pairs, 4096), -(-n_pairs // TASK_PAIRS))  # the pairs of a task stay bounded however many there are
    tiles = cut(classed.withColumn("tile", F.pmod(F.xxhash64("fp"), n_tiles[F.col("ones")]).cast("int")).groupBy("ones", "tile").agg(F.collect_list("fp").alias("fps")))

    def dealt(fps: str, own: tuple[str, str], other: tuple[str, str], sign: int) -> DataFrame:
        """Each tile once for every tile it meets: of its own count and of those up to ``radius`` above (or below)."""
        met = []
        for d in range(radius + 1):
            ones = F.col("ones") + sign * d
            count = F.try_element_at(n_tiles, ones)
            numbers = F.when(count.isNotNull(), F.sequence(F.lit(0), count - 1))
            met.append(F.arrays_zip(F.transform(numbers, lambda t: ones).alias(other[0]), numbers.alias(other[1])))  # noqa: B023 - evaluated at once
        out = tiles.select(F.col("ones").alias(own[0]), F.col("tile").alias(own[1]), F.col("fps").alias(fps), F.explode(F.flatten(F.array_compact(F.array(*met)))).alias("p"))
        return out.select(*own, fps, "p.*").where("ones2 > ones1 or tile2 >= tile1").repartition(n_tasks, "ones1", "tile1", "ones2", "tile2")

    first = dealt("one", ("ones1", "tile1"), ("ones2", "tile2"), 1)
    second = dealt("two", ("ones2", "tile2"), ("ones1", "tile1"), -1)
    alone = F.expr("ones1 = ones2 and tile1 = tile2")
    met = first.join(second, ["ones1", "tile1", "ones2", "tile2"]).select("one", F.when(~alone, F.col("two")).alias("two"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one, two = (batch.column(c)[k] for c in ("one", "two"))
                u, v = tile_links(one.values.to_numpy().view(np.uint64), two.values.to_numpy().view(np.uint64) if two.is_valid else None, radius)
                yield pa.record_batch([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return map_batches(met, run, "u long, v long")


def _marked(docs: DataFrame, doc_id: str, text: str, shingle: int, seed: int, radius: int, tile_rows: int) -> DataFrame:
    marked = cut(fingerprints(docs, doc_id, text, shingle, seed))
    nodes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = star_components(links(nodes.select("fp"), radius, tile_rows))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    named = placed.join(splittable(lows), "root").select(F.col("fp").alias("node_fp"), "root", "component_id")
    return marked.join(named, F.col("fp") == F.col("node_fp")).select("doc_id", "row_key", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS, seed: int = SEED, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(doc_id, fp, component_id) for every row: component_id is the smallest id that is reachable over links."""
    return _marked(docs, doc_id, text, shingle, seed, radius, tile_rows).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS, seed: int = SEED, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates, all columns kept: one row of each component.

    It is the row of the smallest id (of several with that id, the smallest hash of id and
    text; a null id only where there is no other). Rows that agree in id and text are reduced
    to one: only those, if there are any, are grouped.
    """
    found = _marked(docs, doc_id, text, shingle, seed, radius, tile_rows)
    keepers = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row_key")).alias("k")).select("k.doc_id", "k.row_key")
    own_id, own_key, copies = free(docs, "kept_id", "kept_key", "kept_rows")
    keepers = keepers.select(F.col("doc_id").alias(own_id), F.col("row_key").alias(own_key))
    rows = found.groupBy("doc_id", "row_key").agg(F.count(F.lit(1)).alias(copies))
    keepers = cut(rows.join(keepers, same(F.col("doc_id"), F.col(own_id)) & (F.col("row_key") == F.col(own_key))).select(own_id, own_key, copies))
    key = row_key(F.col(doc_id).cast("long"), F.col(text).cast("string"))
    own = docs.join(keepers, same(F.col(doc_id).cast("long"), F.col(own_id)) & (key == F.col(own_key)))
    single = own.where(F.col(copies) == 1).select(*docs.columns)
    repeated = own.where(F.col(copies) > 1).dropDuplicates([own_id, own_key]).select(*docs.columns)
    return single.unionByName(repeated)
