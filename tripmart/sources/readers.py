"""Scans A1-A9."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.schemas import LOCATION_LOOKUP, TRIP_SOURCE

# Conditions under which there is nothing to read at a location.
ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "TABLE_OR_VIEW_NOT_FOUND"}


class MonthsNotLandedError(ValueError):
    """A requested month has no landing folder."""


def read_months(spark: SparkSession, raw_base: str, months: list[str] | None = None,
                schema: T.StructType | None = TRIP_SOURCE, merge_schema: bool = False) -> DataFrame:
    """A1 for one or many months in ONE scan of just their folders (all landed months if none are named).

    ``month`` is the partition column. ``merge_schema`` reads every file footer of these folders
    (metadata only) instead of one. A month without a folder is an error, however many are asked for.
    """
    r = spark.read
    if schema is not None:
        r = r.schema(T.StructType(schema.fields + [T.StructField("month", T.StringType())]))
    elif merge_schema:
        r = r.option("mergeSchema", "true")
    r = r.option("basePath", f"{raw_base}/raw")
    if not months:
        return r.parquet(f"{raw_base}/raw")
    try:
        return r.parquet(*[f"{raw_base}/raw/month={m}" for m in sorted(set(months))])
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise MonthsNotLandedError(str(e).splitlines()[0]) from e
        raise


def fingerprints(spark: SparkSession, raw_base: str, months: list[str]) -> dict[str, str]:
    """What has landed for each month, as a digest of its files' names, sizes and times.

    A listing of these folders, no file is opened; a month without a folder has none.
    """
    out = {}
    for m in sorted(set(months)):
        fs, path = file_system(spark, f"{raw_base}/raw/month={m}")
        if fs.exists(path):
            out[m] = _digest(fs, path)
    return out


def fingerprint(spark: SparkSession, location: str) -> str:
    """The same digest of one file or folder."""
    return _digest(*file_system(spark, location))


def _digest(fs, path) -> str:
    files, listing = [], fs.listFiles(path, True)
    while listing.hasNext():
        f = listing.next()
        name = f.getPath().toString()
        if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
            files.append(f"{name}\t{f.getLen()}\t{f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()


def read_lookup_csv(spark: SparkSession, path: str, schema: T.StructType = LOCATION_LOOKUP) -> DataFrame:
    """A2: CSV lookup with header and a declared schema (saves the inference pass)."""
    return spark.read.option("header", True).schema(schema).csv(path)


def is_path(target: str) -> bool:
    """Tables are addressed by location, or by name (no slash) in the session catalog."""
    return "/" in target


def file_system(spark: SparkSession, location: str):
    """Hadoop's file system and path of a location: listings and deletes without a Spark job."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def read_table(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    """A3: a persisted table by location or by name."""
    return spark.read.format(fmt).load(target) if is_path(target) else spark.table(target)


def month_slice(df: DataFrame, month: str, col: str = "_source_month") -> DataFrame:
    """A4: equality on the partition column -> PartitionFilters at the scan."""
    return df.where(F.col(col) == month)


def folder_exists(spark: SparkSession, location: str) -> bool:
    fs, path = file_system(spark, location)
    return fs.exists(path)


def table_exists(spark: SparkSession, target: str, fmt: str = "parquet") -> bool:
    """Does the table exist? Only a missing path (or a folder without files) means no; any other failure is raised."""
    if not is_path(target):
        return spark.catalog.tableExists(target)
    fs, path = file_system(spark, target)
    if not fs.exists(path):
        return False
    try:
        spark.read.format(fmt).load(target).schema
        return True
    except AnalysisException as e:
        if e.getCondition() in ABSENT:
            return False
        raise


def inventory(df: DataFrame, *by: str) -> DataFrame:
    """File inventory of a file-based frame (file name, size, rows) from the hidden metadata column."""
    return df.select(*by, "_metadata.file_name", "_metadata.file_size").groupBy(*by, "file_name", "file_size").agg(
        F.count(F.lit(1)).alias("row_count")
    )
