"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import line_dedup, packing, periodic_runs, pii, quality_rules, secret_scan, sentencepiece_codec, sharding, simhash, spelling, token_counts, topk, warc
from .common import table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_documents(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts.count_tokens(table(spark, sf_dir, "documents"))
    return out.withColumn("n_tokens", F.col("n_tokens").cast("long"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).drop("archive", "record_offset", "record_length")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), packing.Packing(with_ids=False))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.sanitising_spans(table(spark, sf_dir, "documents")))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_products(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.apply_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.planted(table(spark, sf_dir, "documents"))))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.without_lines(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(spelling.slipped(spelling.occurrences(table(spark, sf_dir, "documents")))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_token_counts": op2_token_counts,
    "op3_warc": op3_warc,
    "op4_packing": op4_packing,
    "op5_sharding": op5_sharding,
    "op6_pii": op6_pii,
    "op7_topk": op7_topk,
    "op8_quality_rules": op8_quality_rules,
    "op9_secret_scan": op9_secret_scan,
    "op10_simhash": op10_simhash,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_line_dedup": op12_line_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}

SHARDING_SQL = f"""
WITH rows AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS doc_bytes,
         ('0x' || substr(md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))), 1, 15))::BIGINT AS h
  FROM documents),
ways AS (SELECT doc_id, doc_bytes, h, d.range::INT AS depth, h >> (60 - d.range)::INT AS p FROM rows, range(0, 61) d),
buckets AS (SELECT depth, p, sum(doc_bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs FROM ways GROUP BY ALL),
leaves AS (
  SELECT w.doc_id, w.doc_bytes, w.h, min(depth) AS local_depth
  FROM ways w JOIN buckets b USING (depth, p)
  WHERE b.shard_bytes <= {sharding.SHARD_BYTES} OR b.shard_docs = 1 GROUP BY ALL)
SELECT l.doc_id, l.doc_bytes, l.local_depth, CASE WHEN l.local_depth = 0 THEN '' ELSE substr(lpad(bin(l.h), 60, '0'), 1, l.local_depth) END AS shard,
       b.shard_bytes, b.shard_docs, b.shard_bytes > {sharding.SHARD_BYTES} AS oversized
FROM leaves l JOIN buckets b ON b.depth = l.local_depth AND b.p = l.h >> (60 - l.local_depth)
"""

WORD = r"[^\x20\x09-\x0D]"
QUALITY_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS t FROM documents),
words AS (SELECT r, unnest(regexp_extract_all(t, '{WORD}+')) AS w, generate_subscripts(regexp_extract_all(t, '{WORD}+'), 1) AS i FROM docs),
windows AS (
  SELECT r, i, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM words WINDOW o AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, i, count(*) OVER (PARTITION BY r, w, w2, w3) AS n FROM windows WHERE w3 IS NOT NULL),
covered AS (SELECT r, count(DISTINCT i + k.range) AS n_repeat_words FROM again, range(0, 3) k WHERE n > 1 GROUP BY r),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS x FROM docs),
by_line AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines FROM lines WHERE regexp_matches(x, '{WORD}') GROUP BY r),
by_word AS (SELECT r, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars FROM words GROUP BY r),
measured AS (
  SELECT r, doc_id, host, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_lines, 0) AS n_lines,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM docs LEFT JOIN by_word USING (r) LEFT JOIN by_line USING (r) LEFT JOIN covered USING (r)),
ruled AS (
  SELECT r, host, unnest([
    {{'rule': 'symbols', 'broken': n_symbols * 100 > n_words * 10}},
    {{'rule': 'dup_lines', 'broken': n_dup_lines * 100 > n_lines * 30}},
    {{'rule': 'word_length', 'broken': word_chars < n_words * 2.0 OR word_chars > n_words * 15.0}},
    {{'rule': 'repeats', 'broken': n_repeat_words * 100 > n_words * 20}}], recursive := true) FROM measured),
hosts AS (SELECT host, rule, count(*)::DOUBLE AS docs, count(*) FILTER (broken)::DOUBLE AS fails FROM ruled GROUP BY host, rule),
moments AS (SELECT rule, sum(docs) AS n, sum(fails) AS f, sum(fails) / sum(docs) AS m, sum(fails * fails / docs) AS sq, count(*) AS k FROM hosts GROUP BY rule),
prior AS (SELECT rule, n, f, least(greatest(m * (1 - m) / greatest(sq / n - m * m - m * (1 - m) * k / n, 1e-9) - 1, 1.0), 1e6) AS k FROM moments),
against AS (SELECT host, rule, docs, fails, k, CASE WHEN n > docs THEN (f - fails) / (n - docs) END AS o FROM hosts JOIN prior USING (rule)),
shrunk AS (SELECT host, rule, o, (fails + o * k) / (docs + k) AS rate FROM against),
bad AS (SELECT host, rule FROM shrunk WHERE rate >= 0.25 AND rate * (1 - o) >= 2.0 * o * (1 - rate)),
out_of_place AS (SELECT DISTINCT ruled.r FROM ruled JOIN bad ON ruled.host IS NOT DISTINCT FROM bad.host AND ruled.rule = bad.rule WHERE broken)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND r NOT IN (SELECT r FROM out_of_place) AS kept
FROM measured
"""

TOPK_SQL = """
WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
           FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

LINE_SQL = r"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM rows),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
frequent AS (SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
told AS (SELECT r, i, line, frequent.k IS NOT NULL AND doc_id IS DISTINCT FROM holder AS dropped FROM keyed LEFT JOIN frequent USING (k))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM told JOIN rows USING (r) GROUP BY r
"""

ORACLE_SQL: dict[str, str] = {"op5_sharding": SHARDING_SQL, "op7_topk": TOPK_SQL, "op8_quality_rules": QUALITY_SQL, "op12_line_dedup": LINE_SQL}
