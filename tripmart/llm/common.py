"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart.session import shared_dir

#: Text bytes that one Python step holds at a time (a longer single row is a slice of its own).
SLICE_BYTES = 8 << 20
#: Bytes of rows that Spark writes into one Arrow batch for a Python step, unless the session says otherwise
#: (Spark's own bound is 10,000 rows, however long they are).
BATCH_BYTES, BATCH_KEY = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Python workers look for the package where the driver has it, whatever their working directory.

    A cluster whose executors have another path ships it with --py-files, and this changes nothing.
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (*paths, PACKAGE_ROOT) if p)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` in batches bounded by bytes: JVM and Python hold a few batches per task, whatever the length of the rows."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_KEY, None) is None:
        conf.set(BATCH_KEY, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def same(a: Column, b: Column) -> Column:
    """Null-safe equality that Spark can still hash-join on."""
    return a.eqNullSafe(b)


def as_binary(col: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    large = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    col = col.cast(pa.large_binary() if large else pa.binary())
    offsets = np.frombuffer(col.buffers()[1], np.int64 if large else np.int32)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    if offsets[-1] == offsets[0]:
        return [x.as_py() for x in col]
    raw = col.buffers()[2][int(offsets[0]) : int(offsets[-1])].to_pybytes()
    bounds = (offsets - offsets[0]).tolist()
    out = [raw[a:b] for a, b in zip(bounds, bounds[1:])]
    for i in np.flatnonzero(col.is_null().to_numpy(zero_copy_only=False)).tolist() if col.null_count else ():
        out[i] = None
    return out


def splittable(df: DataFrame) -> DataFrame:
    """For an aggregate that is joined on its own key: without its partitioning, both sides of the join
    are shuffled for it, and adaptive execution can split the other side's hot keys over tasks."""
    return df.hint("rebalance")


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def thinned(hash_column: str, share: Column) -> Column:
    """Keeps about the given share of all hashes, whatever their order or place; a share of 1 keeps all."""
    return F.shiftrightunsigned(hash_column, 33) < share * 2.0**31


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that the named string column holds about ``most`` bytes, one row at least.

    What Arrow has freed goes back to the system after each batch, as workers live on between tasks.
    """
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < n:
            base = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(begin, end - begin)
            begin = end
        pa.default_memory_pool().release_unused()


def gathered(lists: pa.ListArray, lookup: Callable[[list[bytes]], list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows and their bounds, for rows that are lists of words.

    ``lookup`` gives each distinct word's ids once, as little-endian unsigned 32-bit integers.
    """
    coded = lists.flatten().dictionary_encode()
    found = lookup(as_binary(coded.dictionary))
    flat = np.frombuffer(b"".join(found), "<u4")
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    begins = np.cumsum(sizes) - sizes
    index = coded.indices.to_numpy()
    counts = sizes[index] if len(sizes) else np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    ids = flat[np.repeat(begins[index] - (ends - counts), counts) + np.arange(total)] if total else np.zeros(0, "<u4")
    upto = np.concatenate(([0], ends))
    bounds = lists.offsets.to_numpy().astype(np.int64)
    return ids, upto[bounds - bounds[0]]
