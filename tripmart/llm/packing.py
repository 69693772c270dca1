"""Cost-balanced packing of token documents into sequences.

A document costs ``linear * tokens + quadratic * tokens ** 2`` (attention stays inside it).
Documents are packed in pools of bounded size, within the task that tokenizes them, so no
text or token is shuffled and no group grows with the data. In a pool, documents go in
descending order of cost to the lowest-cost sequence whose remaining capacity holds them; a
document that fits nowhere is cut at the remaining capacity of the lowest-cost open sequence.
Documents longer than a sequence first fill sequences of their own.

A pool opens as many full sequences as its tokens fill, and the rest of its tokens (less than
one sequence) gets sequences of the powers of two that add up to it. Capacities add up to
the pool's tokens, so every sequence is exactly full and nothing is padded.

Defined cases: a null or empty text is the closing id alone; a null id is carried; repeated
rows are packed each; texts of any length are cut whole; an empty table gives no rows; columns
other than id and text are not read. Sequence numbers hold the partition and a count; a
retried task makes the same rows if its input comes in the same order (files do).
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, slices
from .word_ids import WordIds

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class Packing:
    tokenizer: str = public_tokenizers.path("word_bpe_49k.json")
    close_id: int = 2
    max_tokens: int = 4096
    linear: float = 1.0
    quadratic: float = 1.0 / 4096
    pool_sequences: int = 512
    pool_documents: int = 20_000
    with_ids: bool = True


def capacities(total: int, most: int) -> list[int]:
    """Full sequences, then the powers of two that make up the rest."""
    rest = total % most
    return [most] * (total // most) + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def pack(lengths: list[int], how: Packing = Packing()) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece; documents and sequences count from 0."""
    most = how.max_tokens
    open_room = np.array(capacities(sum(lengths), most), np.int64)
    room, cost = open_room.copy(), np.zeros(len(open_room))
    pieces, items, full = [], [], 0
    for d, n in enumerate(lengths):
        whole = n // most
        for k in range(whole):
            pieces.append((d, k * most, most, full, 0))
            room[full] = 0
            full += 1
        if n > whole * most:
            items.append((whole * most - n, d, whole * most))
    heapq.heapify(items)
    while items:
        size, d, start = heapq.heappop(items)
        size = -size
        fits = room >= size
        if not fits.any():
            fits = room > 0
        to = int(np.argmin(np.where(fits, cost, np.inf)))
        put = min(size, int(room[to]))
        pieces.append((d, start, put, to, int(open_room[to] - room[to])))
        room[to] -= put
        cost[to] += how.linear * put + how.quadratic * put * put
        if put < size:
            heapq.heappush(items, (put - size, d, start + put))
    return pieces


_ENCODERS: dict[str, WordIds] = {}


def _encoder(path: str) -> WordIds:
    """One per Python worker, kept between its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordIds(path)
    return _ENCODERS[path]


def pack_documents(docs: DataFrame, how: Packing = Packing(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece; ``ids`` holds its token ids unless ``with_ids`` is off."""

    def emit(pool: list, sequences: int) -> tuple[pa.RecordBatch, int]:
        pieces = pack([len(ids) for _, ids in pool], how)
        cuts = [pool[d][1][start : start + n] for d, start, n, _, _ in pieces]
        columns = [
            pa.array([pool[p[0]][0] for p in pieces], pa.int64()),
            pa.array([p[1] for p in pieces], pa.int64()),
            pa.array([p[2] for p in pieces], pa.int64()),
            pa.array([zlib.crc32(c) for c in cuts], pa.int64()),
            pa.array([len(pool[p[0]][1]) for p in pieces], pa.int64()),
            pa.array([sequences + p[3] for p in pieces], pa.int64()),
            pa.array([p[4] for p in pieces], pa.int64()),
        ]
        names = [c.split()[0] for c in PIECES.split(", ")]
        if how.with_ids:
            bounds = np.cumsum([0, *map(len, cuts)]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(cuts).astype(np.int32))))
            names.append("ids")
        return pa.record_batch(columns, names=names), sequences + 1 + max(p[3] for p in pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(how.tokenizer)
        pool, tokens = [], 0
        sequences = TaskContext.get().partitionId() << 36
        for batch in slices(batches, "text"):
            ids, bounds = encoder.encode(batch.column("text"))
            ids = np.insert(ids, bounds[1:], how.close_id).astype("<u4")
            ends = bounds[1:] + np.arange(1, len(bounds))
            begin = 0
            for key, end in zip(batch.column("doc_id").to_pylist(), ends.tolist()):
                pool.append((key, ids[begin:end]))
                tokens += end - begin
                begin = end
                if tokens >= how.pool_sequences * how.max_tokens or len(pool) >= how.pool_documents:
                    out, sequences = emit(pool, sequences)
                    yield out
                    pool, tokens = [], 0
        if pool:
            yield emit(pool, sequences)[0]

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(named, run, PIECES + (", ids array<int>" if how.with_ids else ""))
