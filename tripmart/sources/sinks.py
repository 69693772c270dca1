"""Table sinks and load control.

Persisted tables are addressed by location or by name in the session catalog, in a
format that is a parameter (``parquet`` by default; ``delta`` where it is installed).
Month tables are written with DYNAMIC partition overwrite: the months in the
frame are replaced, every other month is kept. That makes a first load, an
incremental append and a corrected re-run the same idempotent call; a task or
executor lost mid-write is simply retried by Spark's commit protocol.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.sources.readers import file_system, is_path, read_table, table_exists


#: Parquet files: zstd takes about a fifth fewer bytes than Spark's default for these tables, delta encodings about a tenth fewer again
PARQUET = {"compression": "zstd", "parquet.writer.version": "v2"}
#: months whose files a task keeps open; rows of further months are sorted by month as usual
OPEN_MONTHS = 32
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: splits per core that a scan is cut into, as far as its files go: with one a core, a few more than the cores make a second wave
SPLITS_PER_CORE = 3
SPLITS = "spark.sql.files.minPartitionNum"


@contextmanager
def unsorted_months(spark: SparkSession) -> Iterator[None]:
    """For partitioned writes inside: a task writes the months it meets side by side, without sorting (and spilling) its rows first.

    Frames are clustered by month, so a task meets few, and what its open files buffer is no more than the task's output.
    Scans of many files are split finer than one task a core, unless the session says otherwise.
    """
    own = {WRITERS: str(OPEN_MONTHS)}
    if spark.conf.get(SPLITS, None) is None and (cores := _cores(spark)):
        own[SPLITS] = str(SPLITS_PER_CORE * cores)
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _cores(spark: SparkSession) -> int | None:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - Spark Connect has no context; Spark's own number of splits stays
        return None


def _put(df: DataFrame, target: str, fmt: str, mode: str, part_col: str | list[str] | None = None, **options: str) -> None:
    w = df.write.format(fmt).mode(mode).options(**(PARQUET if fmt == "parquet" else {}), **options)
    if part_col:
        w = w.partitionBy(part_col)
    w.save(target) if is_path(target) else w.saveAsTable(target)


def write_months(df: DataFrame, target: str, fmt: str = "parquet", part_col: str = "_source_month",
                 cluster: bool = True, months: list[str] | None = None, unresolved: str | None = None, outer: str | None = None,
                 added: dict[str, T.DataType] | None = None) -> dict[str, tuple[int, int]]:
    """B1/B2: write (replace) the frame's months; months that are not in the frame stay.

    With ``months``, the rows of each are counted while they are written (B8, B11: neither the source nor
    the table is read again) and returned as month -> (rows, sum of ``unresolved``), a helper column that
    is not written. The counts are taken behind the last shuffle, so a stage that runs again after
    a lost executor is not counted twice. ``outer`` names a column that is partitioned by before the month. ``added`` names columns of the frame
    that a named table is given if it lacks them.

    ``cluster``: rows not already grouped by month are clustered first, so each
    month gets few files instead of (tasks x months). REBALANCE lets AQE split a
    hot month over several tasks and merge small ones, without a sampling pass.
    Frames read from month-partitioned tables are month-clustered already (a
    scan split never mixes many months), so their writes skip that shuffle.
    """
    if cluster:
        df = df.hint("rebalance", part_col)
    spark = df.sparkSession
    seen = Observation("rows_written") if months else None
    if seen is not None:
        # one metric whatever the number of months: the counts of all (month, unresolved) values, which the sketch
        # keeps exactly as long as there are fewer than three quarters of the items it may track
        size = max(4096, 16 * len(months))
        item = F.concat_ws("|", F.col(part_col), F.col(unresolved).cast("long") if unresolved else F.lit(0))
        df = df.withColumn("__item", item).observe(seen, F.count(F.lit(1)).alias("rows"), F.to_json(F.expr(f"approx_top_k(__item, {size}, {size})")).alias("counts")).drop("__item")
    if unresolved:
        df = df.drop(unresolved)
    with unsorted_months(spark):
        if not is_path(target) and spark.catalog.tableExists(target):  # a named table keeps its other partitions only this way
            _fit(df, target, added or {})
            df.select(*spark.table(target).columns).write.mode("overwrite").insertInto(target)
        else:
            _put(df, target, fmt, "overwrite", [outer, part_col] if outer else part_col, partitionOverwriteMode="dynamic")
    out = dict.fromkeys(months or [], (0, 0))
    if seen is not None and seen.get["rows"]:
        found = [(*x["item"].rsplit("|", 1), x["count"]) for x in json.loads(seen.get["counts"])]
        if sum(n for _, _, n in found) != seen.get["rows"]:
            raise RuntimeError("more months than the observed counts can hold")
        for m, u, n in found:
            rows, left = out.get(m, (0, 0))
            out[m] = rows + n, left + n * int(u)
    return out



def _fit(df: DataFrame, target: str, added: dict[str, T.DataType]) -> None:
    """Gives a named table the columns that a declared change adds; another type than the table's is an error before anything
    is written (tables of the session catalog cannot change a column's type; those by location are read with the wider one)."""
    spark, types = df.sparkSession, {f.name: f.dataType for f in df.schema.fields}
    held = {f.name: f.dataType for f in spark.table(target).schema.fields}
    other = sorted(n for n in types.keys() & held.keys() if types[n] != held[n])
    if other:
        raise ValueError(f"table {target} holds other types of {other}; rebuild it, or keep tables by location")
    missing = [n for n in added if n in types and n not in held]
    if missing:
        spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({', '.join(f'`{n}` {types[n].simpleString()}' for n in missing)})")


def drop_months(spark: SparkSession, target: str, months: set[str], part_col: str = "_source_month") -> None:
    """Removes the partitions of months that a replacing write brought no rows for."""
    for m in sorted(months):
        if is_path(target):
            fs, path = file_system(spark, f"{target}/{part_col}={m}")
            fs.delete(path, True)
        else:
            spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({part_col}='{m}')")


def month_folders(spark: SparkSession, target: str, part_col: str = "_source_month") -> list[str]:
    """Months that a table has a partition of: a listing, no job."""
    if not is_path(target):
        if not spark.catalog.tableExists(target):
            return []
        return sorted(r[0].split(f"{part_col}=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {target}").collect())
    fs, path = file_system(spark, target)
    if not fs.exists(path):
        return []
    names = (f.getPath().getName() for f in fs.listStatus(path) if f.isDirectory())
    return sorted(n.removeprefix(f"{part_col}=") for n in names if n.startswith(f"{part_col}="))


def month_rows(df: DataFrame, months: list[str], part_col: str = "_source_month") -> dict[str, int]:
    """Rows of each month that has any (on a month-partitioned table: partition pruning and row counts of footers)."""
    got = df.where(F.col(part_col).isin(sorted(set(months)))).groupBy(part_col).agg(F.count(F.lit(1)).alias("n"))
    return {r[0]: int(r["n"]) for r in got.collect()}


def rebuild(df: DataFrame, target: str, fmt: str = "parquet") -> int:
    """Full overwrite (schema may change)."""
    obs = Observation("rows_rebuilt")
    options = {"overwriteSchema": "true"} if fmt == "delta" else {}
    _put(df.observe(obs, F.count(F.lit(1)).alias("rows")), target, fmt, "overwrite", partitionOverwriteMode="static", **options)
    return int(obs.get.get("rows", 0))


def relay(df: DataFrame, folder: str) -> None:
    """Replaces the files of one landing folder (whose rows ``df`` must not read from it)."""
    _put(df, folder, "parquet", "overwrite", partitionOverwriteMode="static")


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """Files of one folder, without markers and hidden ones."""
    fs, path = file_system(spark, folder)
    names = [f.getPath() for f in fs.listStatus(path) if f.isFile()]
    return sorted(p.toString() for p in names if not p.getName().startswith(("_", ".")))


def remove_files(spark: SparkSession, files: set[str]) -> None:
    for f in sorted(files):
        fs, path = file_system(spark, f)
        fs.delete(path, False)


def append(df: DataFrame, target: str, fmt: str = "parquet") -> int:
    """B5 replacement: append only a computed delta (never read-modify-overwrite one table)."""
    obs = Observation("rows_appended")
    _put(df.observe(obs, F.count(F.lit(1)).alias("rows")), target, fmt, "append")
    return int(obs.get.get("rows", 0))


def months_present(spark: SparkSession, path: str, months: list[str], fmt: str = "parquet",
                   part_col: str = "_source_month") -> set[str]:
    """Which of ``months`` already hold rows (partition-pruned, distinct months only)."""
    if not table_exists(spark, path, fmt):
        return set()
    return set(month_rows(read_table(spark, path, fmt), months, part_col))


LEDGER = "month string, stage string, status string, rows long, finished_at timestamp_ntz, fingerprint string, unresolved long"


def ledger_append(spark: SparkSession, path: str, rows: list[tuple], fmt: str = "parquet") -> dt.datetime:
    """Run ledger: (month, stage, status, rows, fingerprint, unresolved) with the time, one row per stage and month,
    appended right after the stage's write committed; the status of a month without rows is ``empty``."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    data = [(m, s, st, int(n), now, fp, un) for (m, s, st, n, fp, un) in rows]
    df = spark.createDataFrame(data, LEDGER).coalesce(1)
    if not is_path(path) and spark.catalog.tableExists(path):
        df = df.select(*spark.table(path).columns)  # a ledger of an earlier version has fewer columns
    _put(df, path, fmt, "append")
    return now
