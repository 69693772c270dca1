"""Line dedup over levelled sorted runs of line hashes, in DataFrame and SQL functions only.

A line's key is the line without white space at both ends and with A-Z lower-cased; keys of at
least ``least_chars`` code points count. A key is frequent once ``least_documents`` documents
hold it. Frequent keys lose all their lines except in the document of the largest id.

1. One pass over the texts writes the hashes of the long lines (128 bits) with document and
   position, by batch. Batches are ranges of ids, the largest ids first, so the first document
   that shows a key is the one that keeps it.
2. ``LineRuns`` is the index: runs of (hash, documents, holder), each written as a table
   bucketed and sorted by the hash. Each new batch is reduced to one row per hash, merge-anti-joined with
   the runs' settled hashes (frequent already: nothing about them can change) and what is left
   becomes a run of its own. Whenever a level has ``fanout`` runs they are merged into one run
   of the next level. Buckets line up, so these joins and merges read runs without a shuffle.
   A line that millions of documents share is written to few runs and then never again.
3. The frequent hashes meet the lines, which gives the positions to drop, gathered per document
   (not more than its lines). Documents without any keep their text untouched.

Partial sums come before every shuffle of hashes, and joins with the frequent hashes can be split
on a hot hash by adaptive execution. Tables of a call are in the shared folder, with unique names.

Defined cases: a null or empty text is one empty line; rows that share an id are one document;
a row without id counts as no document and holds no key, so it loses its frequent lines; repeated
rows are treated alike, each giving a row; texts of any length are read whole; an empty table
gives no rows; other columns are only carried where whole rows are returned.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import scratch_root

from .common import free, same, splittable

#: fixed values: white space that is stripped
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Lines:
    least_chars: int = 40
    least_documents: int = 5
    batches: int = 4
    fanout: int = 2
    #: 0: as many buckets as the session has shuffle partitions
    buckets: int = 0


def line_key(line: Column) -> Column:
    """The stripped line with A-Z in lower case (``lower`` does just that where all is ASCII, and is faster)."""
    bare = F.btrim(line, F.lit(SPACES))
    return F.when(F.length(bare) == F.octet_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def long_lines(docs: DataFrame, how: Lines, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, pos, h1, h2) of every line whose key is long enough; pos counts from 0."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    rows = rows.where(F.length("line") >= how.least_chars).withColumn("key", line_key(F.col("line"))).where(F.length("key") >= how.least_chars)
    return rows.select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


class LineRuns:
    """Sorted runs of line hashes in levels; ``add`` takes one batch of (doc_id, h1, h2) after another."""

    def __init__(self, spark: SparkSession, how: Lines = Lines()) -> None:
        self.spark, self.how = spark, how
        self.buckets = how.buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.root = scratch_root(spark, "line-runs")
        self.name = f"line_run_{uuid.uuid4().hex[:12]}"
        self.made = 0
        self.levels: list[list[str]] = [[]]

    def _write(self, rows: DataFrame) -> str:
        """A run: hash buckets, sorted by the hash within."""
        self.made += 1
        name = f"{self.name}_{self.made}"
        rows = rows.repartition(self.buckets, "h1")
        rows.write.bucketBy(self.buckets, "h1").sortBy("h1", "h2").option("path", f"{self.root}/{self.made}").format("parquet").saveAsTable(name)
        return name

    def _merge(self, names: list[str]) -> DataFrame:
        """One row per hash of some runs: documents add up, the largest holder stays."""
        rows = self.spark.table(names[0])
        for name in names[1:]:
            rows = rows.unionByName(self.spark.table(name))
        return rows.groupBy("h1", "h2").agg(F.sum("n_documents").alias("n_documents"), F.max("holder").alias("holder"))

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def add(self, batch: DataFrame) -> None:
        """Takes in a batch. Batches come in descending order of ids and no document is in two of them."""
        own = batch.where(F.col("doc_id").isNotNull()).select("h1", "h2", "doc_id").distinct().groupBy("h1", "h2")
        own = own.agg(F.count(F.lit(1)).alias("n_documents"), F.max("doc_id").alias("holder"))
        if self.runs():
            settled = self._merge(self.runs()).where(F.col("n_documents") >= self.how.least_documents)
            own = own.join(settled.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        self.levels[0].append(self._write(own))
        level = 0
        while len(self.levels[level]) >= self.how.fanout:
            merged = self._write(self._merge(self.levels[level]))
            for name in self.levels[level]:
                self.spark.sql(f"DROP TABLE {name}")  # the files stay in the shared folder
            self.levels[level] = []
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(merged)
            level += 1

    def frequent(self) -> DataFrame:
        """(h1, h2, holder) of the hashes that enough documents hold; read from the files, whatever happens to the tables."""
        rows = None
        for name in self.runs():
            run = self.spark.read.schema("h1 long, h2 long, n_documents long, holder long").parquet(f"{self.root}/{name.rsplit('_', 1)[1]}")
            rows = run if rows is None else rows.unionByName(run)
        merged = rows.groupBy("h1", "h2").agg(F.sum("n_documents").alias("n"), F.max("holder").alias("holder"))
        return merged.where(F.col("n") >= self.how.least_documents).select("h1", "h2", "holder")

    def close(self) -> None:
        """Forgets the tables' names."""
        for name in self.runs():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _batch_of(docs: DataFrame, how: Lines, doc_id: str) -> Column:
    """The batch of a row: ranges of about equal numbers of rows, the largest ids first, rows without id last."""
    shares = [k / how.batches for k in range(1, how.batches)]
    bounds = docs.select(F.percentile_approx(F.col(doc_id).cast("long"), F.array(*map(F.lit, shares)), F.lit(10_000))).first()[0] if shares else None
    batch = F.lit(how.batches - 1)
    for k, bound in enumerate(sorted(set(bounds or []))):
        batch = F.when(F.col("doc_id") > bound, how.batches - 2 - k).otherwise(batch)
    return batch


def dropped_lines(docs: DataFrame, how: Lines = Lines(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, dropped): positions of the lines to drop, for rows that lose any."""
    spark = docs.sparkSession
    written = f"{scratch_root(spark, 'long-lines')}"
    long_lines(docs, how, doc_id, text).withColumn("batch", _batch_of(docs, how, doc_id)).write.partitionBy("batch").parquet(written)
    lines = spark.read.schema("doc_id long, text_hash long, pos int, h1 long, h2 long, batch int").parquet(written)
    index = LineRuns(spark, how)
    try:
        for batch in range(how.batches):
            index.add(lines.where(F.col("batch") == batch).select("doc_id", "h1", "h2"))
    finally:
        index.close()
    found = lines.join(splittable(index.frequent()), ["h1", "h2"]).where(~same(F.col("doc_id"), F.col("holder")))
    return found.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("dropped"))


def without_lines(docs: DataFrame, how: Lines = Lines(), doc_id: str = "doc_id", text: str = "text", n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """The rows of ``docs`` with the lines dropped from their texts, and how many lines they had and lost.

    A text that loses nothing is left as it is (null too).
    """
    key, text_hash, lines, drops = free(docs, "key", "text_hash", "lines", "dropped")
    found = dropped_lines(docs, how, doc_id, text).select(F.col("doc_id").alias(f"{key}2"), F.col("text_hash").alias(f"{text_hash}2"), F.col("dropped").alias(drops))
    whole = F.col(text).cast("string")
    # the text travels as the array of its lines: it is split once, below the join, and lines are then looked up in place
    rows = docs.withColumns({key: F.col(doc_id).cast("long"), text_hash: F.xxhash64(whole), lines: F.split(whole, "\n", -1)}).drop(text)
    rows = rows.join(splittable(found), same(F.col(key), F.col(f"{key}2")) & (F.col(text_hash) == F.col(f"{text_hash}2")), "left")
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drops)  # by a hash set; keeps the order
    kept = F.when(F.col(drops).isNull(), F.col(lines)).otherwise(F.transform(places, lambda i: F.get(F.col(lines), i)))
    counts = {n_lines: F.when(F.col(lines).isNull(), 1).otherwise(F.size(lines)).cast("long"), n_dropped: F.when(F.col(drops).isNull(), 0).otherwise(F.size(drops)).cast("long")}
    return rows.withColumns({text: F.array_join(kept, "\n"), **counts}).select(*docs.columns, n_lines, n_dropped)


def digest(kept: DataFrame) -> DataFrame:
    """Line counts and the hash of the text that is left."""
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
