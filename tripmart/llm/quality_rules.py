"""Host-level quality rules.

Each document is measured once (words, symbols, repeated lines and word windows).
The outcomes of the rules are summed per host, the host's failure rate of each rule
is shrunk with an empirical beta prior (mean: the rate of all other hosts; strength: fitted to all
hosts by moments), and a host is *bad* for that rule if its shrunk rate is high and its odds are far above
those of all other hosts. The host itself is not in what it is held against, so a host of any share of the rows can be bad,
and odds leave room above every rate. Where there is no other host, none is bad. The verdict is joined back:
a document is dropped if it breaks a base rule, or if it breaks a host rule for which
its host is bad. A document that breaks no rule is kept wherever it comes from.

Defined cases: a null or empty text has no words (so it breaks the length rule); a null
host is a host of its own; every input row gives one row, repeated ids included; an empty
table gives no rows; columns other than the three named ones are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_binary, cut, free, map_batches, same, slices, splittable

WORD_SEPARATORS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
MEASURES = "doc_id long, row_key long, host string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 50
    max_repeat_pct: int = 50
    #: host rules, in percent
    max_symbol_pct: int = 10
    max_dup_line_pct: int = 30
    min_mean_word: float = 2.0
    max_mean_word: float = 15.0
    soft_repeat_pct: int = 20
    #: a host is bad for a rule if its shrunk rate reaches the first and its odds the second times the other hosts' odds
    bad_rate: float = 0.25
    bad_lift: float = 2.0

    def host_rules(self) -> dict[str, Column]:
        words, chars = F.col("n_words"), F.col("word_chars")
        return {
            "symbols": F.col("n_symbols") * 100 > words * self.max_symbol_pct,
            "dup_lines": F.col("n_dup_lines") * 100 > F.col("n_lines") * self.max_dup_line_pct,
            "word_length": (chars < words * self.min_mean_word) | (chars > words * self.max_mean_word),
            "repeats": F.col("n_repeat_words") * 100 > words * self.soft_repeat_pct,
        }


def measure_text(raw: bytes) -> tuple[int, int, int, int, int, int]:
    """(words, code points in words, symbols, lines with a word, repeated lines, words in repeated 3-word windows)."""
    words = raw.split()  # bytes split on exactly the six ASCII separators
    n = len(words)
    if not n:
        return 0, 0, 0, 0, 0, 0
    solid = raw.translate(None, WORD_SEPARATORS)
    chars = len(solid) if solid.isascii() else len(solid.decode("utf-8", "replace"))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    covered, upto = 0, 0
    if n >= 3:
        windows = list(zip(words, words[1:], words[2:]))
        counts = Counter(windows)
        if len(counts) < len(windows):
            for i, w in enumerate(windows):
                if counts[w] > 1:
                    covered += i + 3 - max(i, upto)
                    upto = i + 3
    return n, chars, symbols, len(lines), len(lines) - len(set(lines)), covered


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows = [measure_text(x or b"") for x in as_binary(batch.column("text"))]
        yield pa.record_batch(
            [batch.column("doc_id"), batch.column("row_key"), batch.column("host").cast(pa.string()), *(pa.array(c, pa.int64()) for c in zip(*rows))],
            names=["doc_id", "row_key", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"],
        )


def row_key(text: Column, host: Column) -> Column:
    return F.xxhash64(text, host)


def measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(host).cast("string").alias("host"))
    return map_batches(named.select("doc_id", row_key(F.col("text"), F.col("host")).alias("row_key"), "host", "text"), _measure, MEASURES)


def host_verdicts(measured: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """One row per host and rule: documents, failures, shrunk rate, the other hosts' rate, ``bad``.

    The prior of a host and rule is Beta(o k, (1 - o) k): o is the rate of all other hosts, and k comes
    from the variance of the host rates beyond what binomial noise explains.
    """
    hard = rules.host_rules()
    per_host = measured.groupBy("host").agg(F.count(F.lit(1)).alias("docs"), *(F.count_if(c).alias(r) for r, c in hard.items()))
    long = per_host.select("host", "docs", F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("fails")) for r in hard))).alias("x")).select("host", "docs", "x.*")
    prior = long.groupBy("rule").agg(
        F.sum("docs").cast("double").alias("all_docs"),
        F.sum("fails").cast("double").alias("all_fails"),
        (F.sum("fails") / F.sum("docs")).alias("m"),
        F.sum(F.col("fails").cast("double") * F.col("fails") / F.col("docs")).alias("squares"),
        F.count(F.lit(1)).alias("hosts"),
    )
    noise = F.col("m") * (1 - F.col("m"))
    between = F.greatest(F.col("squares") / F.col("all_docs") - F.col("m") * F.col("m") - noise * F.col("hosts") / F.col("all_docs"), F.lit(1e-9))
    prior = prior.select("rule", "all_docs", "all_fails", F.least(F.greatest(noise / between - 1, F.lit(1.0)), F.lit(1e6)).alias("k"))
    others = F.when(F.col("all_docs") > F.col("docs"), (F.col("all_fails") - F.col("fails")) / (F.col("all_docs") - F.col("docs")))
    held = long.join(prior, "rule").withColumn("others", others)
    rate = (F.col("fails") + F.col("others") * F.col("k")) / (F.col("docs") + F.col("k"))
    above = F.col("rate") * (1 - F.col("others")) >= rules.bad_lift * F.col("others") * (1 - F.col("rate"))
    bad = F.coalesce((F.col("rate") >= rules.bad_rate) & above, F.lit(False))
    return held.withColumn("rate", rate).select("host", "rule", "docs", "fails", "rate", "others", bad.alias("bad"))


def apply_rules(docs: DataFrame, rules: QualityRules = QualityRules(), doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Measures, base outcome, broken host rules and verdict of every document.

    The measures are narrow and are checkpointed once, as both the host sums and the
    verdicts read them: the texts are read one time.
    """
    measured = cut(measures(docs, doc_id, text, host))
    verdicts = host_verdicts(measured, rules).groupBy("host").agg(F.collect_set(F.when(F.col("bad"), F.col("rule"))).alias("bad_rules"))
    broken = F.array_compact(F.array(*(F.when(c, F.lit(r)) for r, c in rules.host_rules().items())))
    base = (F.col("n_words") < rules.min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_pct)
    judged = measured.withColumns({"base_failed": base, "broken": broken}).withColumnRenamed("host", "doc_host")
    out = judged.join(splittable(verdicts), same(F.col("doc_host"), F.col("host")), "left")
    bad_host = F.coalesce(F.arrays_overlap("broken", "bad_rules"), F.lit(False))
    return out.select(
        "doc_id", "row_key", F.col("doc_host").alias("host"), "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
        "base_failed", "broken", (~F.col("base_failed") & ~bad_host).alias("kept"),
    )


def kept_documents(docs: DataFrame, rules: QualityRules = QualityRules(), doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are.

    Rows find their verdict by id and a hash of text and host; rows that agree in these share
    one verdict, so all of them stay or go.
    """
    judged = apply_rules(docs, rules, doc_id, text, host)
    own_id, own_key = free(docs, "kept_id", "kept_key")
    kept = judged.where("kept").select(F.col("doc_id").alias(own_id), F.col("row_key").alias(own_key)).distinct()
    key = row_key(F.col(text).cast("string"), F.col(host).cast("string"))
    return docs.join(splittable(kept), same(F.col(doc_id).cast("long"), F.col(own_id)) & (key == F.col(own_key)), "left_semi")
