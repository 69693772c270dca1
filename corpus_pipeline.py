"""Corpus pipeline: quality rules, near-duplicates, secrets, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last
return the columns of ``docs``, further and clashing ones included. ``run`` applies them to the whole table.

In every stage: null ids and null values in any column are carried; a null or empty text is a document without
words; texts of any length are read whole; rows that repeat id and text share one verdict; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import packing, quality_rules, secret_scan, simhash
from tripmart.llm.common import table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality rules reject (null and empty texts are too short; a null source is a host of its own)."""
    return quality_rules.kept_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: the one of the smallest id; of rows that repeat it, one."""
    return simhash.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks the secrets in the texts, null texts stay null; ``n_chars``, if there is one that is not null, follows the text."""
    masked = secret_scan.mask_documents(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into training sequences: one row per piece; a null or empty text is the closing id alone."""
    return packing.pack_documents(docs)


STAGES = [("quality_rules", keep_good), ("simhash_near_dedup", drop_near_copies), ("secret_scan", mask_secrets), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs


#: the near-duplicate and learned stages have no SQL form; tests hold the pipeline against a brute-force version
ORACLE_SQL = None
