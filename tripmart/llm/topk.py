"""Exact top-k inner products over norm-sorted, SVD-rotated vectors.

1. Components become integers, floor(scale * x); scores are exact integer inner products.
2. The Gram matrix of all vectors (d * d, summed per task) gives the rotation: its
   eigenvectors are the right singular vectors of the whole set. An inner product is the
   same in rotated form, and its first few terms carry most of it.
3. Vectors are range-partitioned by descending length into blocks of bounded size; within a
   length the id decides, so equal vectors spread over blocks as well.
4. Queries go in blocks too. Each block of queries first meets the block of the longest
   vectors, which gives every query a floor: its k-th score there. The floors go along to
   the blocks that the Cauchy-Schwarz bound |q| * max|v| does not rule out; a task joins one
   block of vectors with at most LANE_BLOCKS blocks of queries.
5. A task takes its vectors in slices of descending length. After the first ``head`` rotated
   terms, a pair goes on only if partial sum + |rest of q| * |rest of v| can still reach the
   query's floor; only the pairs left get their exact integer product. Bounds carry a slack
   for rounding, so nothing is lost to it; ties at the floor go on.

Defined cases: vectors that are null, empty of an id, or hold null or non-finite components
take no part; components of any size are exact (doubles from 2**53 on are whole numbers), and a
score that does not fit a long is an error, as in the SQL; shorter vectors end in zeros; rows that share an id are all candidates for
others and none for their own id; query rows that agree in id and vector are answered once;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SCALE = 256
BLOCK_ROWS, QUERY_ROWS, LANE_BLOCKS = 4096, 256, 64


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v, squares): integer components and squared length of every vector that takes part."""
    x = F.col(embedding)
    sound = ~F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    scaled = F.transform(x, lambda c: c.cast("double") * scale)
    whole = F.transform(scaled, lambda y: F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y))
    taken = vectors.where(F.col(vec_id).isNotNull() & x.isNotNull() & F.coalesce(sound, F.lit(False))).select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("v"))
    return taken.withColumn("squares", F.aggregate("v", F.lit(0).cast("double"), lambda a, c: a + c * c))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to the width."""
    bounds = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy()
    sizes = np.diff(bounds)
    if len(sizes) and (sizes == width).all():
        return flat[bounds[0] : bounds[-1]].reshape(-1, width)
    out = np.zeros((len(sizes), width))
    for i, n in enumerate(sizes):
        out[i, :n] = flat[bounds[i] : bounds[i] + n]
    return out


def rotation(whole: DataFrame) -> np.ndarray:
    """Right singular vectors of the set, strongest first, from a Gram matrix summed per task and then per cell."""
    width = whole.agg(F.max(F.size("v"))).first()[0] or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column("v"), width).astype(np.float64)
            gram += m.T @ m
        yield pa.record_batch([pa.array(np.repeat(np.arange(width), width)), pa.array(np.tile(np.arange(width), width)), pa.array(gram.ravel())], names=["i", "j", "g"])

    cells = whole.select("v").mapInArrow(run, "i long, j long, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).collect()  # width * width
    gram = np.zeros((width, width))
    for i, j, g in cells:
        gram[i, j] = g
    return np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1].copy()


class Block:
    """Vectors by descending length, with their rotated form and lengths."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, turn: np.ndarray, head: int) -> None:
        self.ids, self.vectors = ids, vectors
        turned = vectors @ turn
        self.head = np.ascontiguousarray(turned[:, :head])
        self.rest = np.sqrt((turned[:, head:] ** 2).sum(axis=1))
        self.lengths = np.sqrt((turned**2).sum(axis=1))


def whole_numbers(m: np.ndarray, fits: bool) -> np.ndarray:
    """Whole doubles as 64-bit integers, or as integers of any size where products need more."""
    return m.astype(np.int64) if fits else np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)


def search(asked: Block, floors: np.ndarray, block: Block, k: int, step: int = 512) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, scores) of each query's best k in the block; what is below a query's floor may be missing."""
    slack = 1e-9 * asked.lengths * block.lengths.max(initial=0) + 1e-6
    most = np.abs(asked.vectors).sum(axis=1).max(initial=0) * np.abs(block.vectors).max(initial=0)
    exact, fits = most < 2**52, max(most, np.abs(asked.vectors).max(initial=0), np.abs(block.vectors).max(initial=0)) < 2**62
    q, v = (asked.vectors, block.vectors) if exact else (whole_numbers(asked.vectors, fits), whole_numbers(block.vectors, fits))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in asked.ids]
    floors = floors.copy()
    for at in range(0, len(block.ids), step):
        live = np.flatnonzero(asked.lengths * block.lengths[at : at + step].max() + slack >= floors)
        if not len(live):
            break  # later vectors are shorter still
        part = slice(at, at + step)
        reach = asked.head[live] @ block.head[part].T + asked.rest[live, None] * block.rest[None, part] + slack[live, None]
        rows, cols = np.nonzero((reach >= floors[live, None]) & (asked.ids[live, None] != block.ids[None, part]))
        if exact and len(rows) > reach.size // 8:
            scores = np.rint(q[live] @ v[part].T).astype(np.int64)[rows, cols]
        else:
            scores = (np.einsum("nd,nd->n", q[live[rows]], v[at + cols]) if exact or fits else (q[live[rows]] * v[at + cols]).sum(axis=1)).astype(np.int64)
        ends = np.searchsorted(rows, np.arange(len(live) + 1))
        for n in np.flatnonzero(np.diff(ends)):
            i, some = live[n], slice(ends[n], ends[n + 1])
            ids, points = np.concatenate((found[i][0], block.ids[at + cols[some]])), np.concatenate((found[i][1], scores[some]))
            keep = np.lexsort((ids, -points))[:k]
            found[i] = ids[keep], points[keep]
            if len(keep) == k:
                floors[i] = max(floors[i], float(points[keep[-1]]))
    return found


def _packer(rows: int, width: int):
    """Sorted vectors in, one row per block of at most ``rows`` vectors out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                packed = _matrix(part.column("v"), width).astype("<f8").tobytes()
                longest = float(np.sqrt(part.column("squares").to_numpy().max()))
                yield pa.record_batch([pa.array([part.column("vec_id").to_numpy().tobytes()], pa.binary()), pa.array([packed], pa.binary()), pa.array([longest])], names=["ids", "m", "longest"])

    return run


def _blocks(whole: DataFrame, rows: int, width: int, number: str) -> DataFrame:
    """Blocks of descending length, numbered from 0."""
    order = [F.col("squares").desc(), F.col("vec_id")]
    parts = max(1, -(-whole.count() // rows))
    packed = cut(whole.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_packer(rows, width), "ids binary, m binary, longest double").withColumn("at", F.monotonically_increasing_id()))
    numbers = packed.select("at", F.spark_partition_id().alias("p"))
    before = numbers.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"))  # one row per partition
    before = before.select("p", "low", (F.sum("n").over(Window.orderBy("p")) - F.col("n")).alias("before"))
    return cut(packed.withColumn("p", F.spark_partition_id()).join(F.broadcast(before), "p").select((F.col("before") + F.col("at") - F.col("low")).alias(number), "ids", "m", "longest"))


def top_products(vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE, head: int = 16) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all vectors for every query row, without the query's own id."""
    whole = cut(whole_vectors(vectors, vec_id, embedding, scale))
    asked = cut(whole_vectors(queries, vec_id, embedding, scale).distinct())
    turn = rotation(whole)
    width = len(turn)
    head = min(head, width)
    blocks = _blocks(whole, BLOCK_ROWS, width, "block")
    asked = _blocks(asked, QUERY_ROWS, width, "q_block")
    longest = blocks.where("block = 0").collect()  # one block, of bounded size
    n_blocks, lanes = blocks.count(), max(1, -(-asked.count() // LANE_BLOCKS))

    def read(ids: bytes, m: bytes) -> Block:
        return Block(np.frombuffer(ids, np.int64), np.frombuffer(m, "<f8").reshape(-1, width), turn, head)

    def open_floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = read(longest[0]["ids"], longest[0]["m"])
        for batch in batches:
            for r in batch.to_pylist():
                q = read(r["ids"], r["m"])
                found = search(q, np.full(len(q.ids), -np.inf), top, k)
                floors = np.array([s[-1] if len(s) == k else -np.inf for _, s in found])
                need = float(np.min(np.where(floors > 0, floors / np.maximum(q.lengths, 1e-300), -1.0)))
                yield pa.record_batch([pa.array([r["q_block"]]), pa.array([r["ids"]], pa.binary()), pa.array([r["m"]], pa.binary()), pa.array([floors.tobytes()], pa.binary()), pa.array([need * (1 - 1e-9)])], names=["q_block", "ids", "m", "floors", "need"])

    opened = cut(asked.select("q_block", "ids", "m").mapInArrow(open_floors, "q_block long, ids binary, m binary, floors binary, need double"))
    # which blocks a query block has to meet: narrow rows; its vectors follow only to those
    met = opened.select("q_block", "need", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("block")) if n_blocks else opened.select("q_block", "need", F.lit(0).cast("long").alias("block")).limit(0)
    met = met.join(blocks.select("block", "longest"), "block").where(F.col("longest") >= F.col("need")).select("q_block", "block")
    left = met.join(opened.drop("need"), "q_block").withColumn("lane", F.pmod("q_block", F.lit(lanes)))
    right = blocks.select("block", "ids", "m").withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))))

    def meet(key: tuple, some: pa.Table, block: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        for b in block.to_pylist():
            v = read(b["ids"], b["m"])
            for r in some.to_pylist():
                q = read(r["ids"], r["m"])
                found = search(q, np.frombuffer(r["floors"], np.float64), v, k)
                sizes = [len(i) for i, _ in found]
                for column, x in zip(out, (np.full(sum(sizes), r["q_block"]), np.repeat(np.arange(len(q.ids)), sizes), np.repeat(q.ids, sizes), *(np.concatenate([f[n] for f in found]) for n in (0, 1)))):
                    column.append(x)
        return pa.table([pa.array(np.concatenate(c).astype(np.int64) if c else [], pa.int64()) for c in out], names=["q_block", "q_row", "query_id", "vec_id", "score"])

    found = left.groupBy("block", "lane").cogroup(right.groupBy("block", "lane")).applyInArrow(meet, "q_block long, q_row long, query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("q_block", "q_row").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
