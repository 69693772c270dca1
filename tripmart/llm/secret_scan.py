"""Secret scan: fixed patterns, and a learned detector over every other candidate.

Patterns give the base spans. Further candidates are runs of six key characters or more, unless
they are made of plain words (letters in lower case, upper case or capitalised, at most 40), and
whatever base spans leave of a run. A character network scores each candidate with its context;
base spans are the labelled findings, long plain words that no pattern matches are the
non-findings, and the candidates themselves are unlabelled, as real secrets may be among them:
a first network, trained on the one half, tells findings from all others; its mean over the
findings of the other half, c, gives the chance of every unlabelled candidate there to be a
finding that the patterns missed, (1 - c) / c * p / (1 - p), and the network in use is trained
on that half with these chances as labels.
Training takes every distinct value of the corpus, as do calibration and threshold: shards of the
rows are trained side by side and their weights averaged after each pass. The first half serves for
calibration and for the threshold, which is the highest one that keeps ``min_recall`` of the held-out
findings; precision is measured only. With fewer than two findings or two others there is nothing to learn from.

Defined cases: null and empty texts have no spans; a candidate longer than a window is scored in
overlapping windows, and the largest probability decides for the whole; every input row gives one row, repeated ids included; an empty table gives no rows;
columns other than id and text are only carried where whole rows are returned.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .char_cnn import CharCnn, encode, newton, window, window_starts
from .common import cut, map_batches, slices

#: fixed values: kinds in order, their patterns and least lengths
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is maximal from its first character on, so shorter runs can be passed over
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_ASSIGN, MIN_ACCESS = 6, 20

LEARNED = "learned"
KEY = "[A-Za-z0-9+/_=-]"
WORDS = r"[+/_=-]*+(?:(?:[A-Z]?[a-z]{1,40}+|[A-Z]{1,40}+)(?:[+/_=-]++|(?![A-Za-z0-9])))*+"
RUN = re.compile(rf"(?<!{KEY}){KEY}{{6,}}+")
PLAIN_RUN = re.compile(WORDS)
PLAIN_WORD = re.compile(r"(?<![A-Za-z])(?:[A-Z]?[a-z]{11,40}|[A-Z]{12,40})(?![A-Za-z])")
SCORED = 4096  # windows that are encoded and scored at a time
MASK = "[SECRET]"

FINDING, RUN_ONLY, PLAIN = 1, 0, -1  # strata of the training rows: findings, unlabelled, non-findings
WINDOW = "stratum int, before string, value string, after string"
BATCH = 64

Span = tuple[str, int, int, int]  # kind, start, end, start of the secret value


@dataclass(frozen=True)
class SecretScan:
    shard_rows: int = 8192  # training rows that one task trains on
    passes: int = 6  # over all training rows, more until ``steps`` were made
    steps: int = 1500
    min_recall: float = 0.95
    plain_words: int = 1  # plain words per text among the non-findings
    seed: int = 7


def base_spans(text: str) -> list[Span]:
    """Pattern matches by start, then kind; matches that fail their length are dropped, not retried."""
    found: list[Span] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """Runs that are not plain words, and what base spans leave of any run."""
    areas: list[list[int]] = []
    for _, start, end, _ in spans:
        if areas and start <= areas[-1][1]:
            areas[-1][1] = max(areas[-1][1], end)
        else:
            areas.append([start, end])
    out, at = [], 0
    for m in RUN.finditer(text):
        begin, stop = m.span()
        while at < len(areas) and areas[at][1] <= begin:
            at += 1
        if at == len(areas) or areas[at][0] >= stop:
            if not PLAIN_RUN.fullmatch(text, begin, stop):
                out.append((begin, stop))
            continue
        k = at
        while k < len(areas) and areas[k][0] < stop:
            out.append((begin, areas[k][0]))
            begin = areas[k][1]
            k += 1
        out.append((begin, stop))
    return [(s, e) for s, e in out if s < e and any(c.isalnum() for c in text[s:e])]


def _labelled(texts: Iterator[str], how: SecretScan) -> Iterator[tuple[int, str, str, str]]:
    for text in texts:
        spans = base_spans(text)
        for _, start, end, value in spans:
            yield FINDING, *window(text, value, end)
        for start, end in candidates(text, spans):
            yield RUN_ONLY, *window(text, start, end)
        for k, m in enumerate(PLAIN_WORD.finditer(text)):
            if k == how.plain_words:
                break
            if not any(s < m.end() and m.start() < e for _, s, e, _ in spans):
                yield PLAIN, *window(text, m.start(), m.end())


def training_rows(docs: DataFrame, how: SecretScan = SecretScan(), text: str = "text") -> DataFrame:
    """(stratum, before, value, after, target, shard, first): every distinct value of each stratum, in two halves of each side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = list(_labelled((x or "" for x in batch.column("text").to_pylist()), how))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.record_batch([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.string()) for c in columns[1:])], names=["stratum", "before", "value", "after"])

    found = map_batches(docs.select(F.col(text).cast("string").alias("text")), run, WINDOW)
    distinct = cut(found.groupBy("stratum", "value").agg(F.min(F.struct("before", "after")).alias("c")).select("stratum", "c.before", "value", "c.after"))
    finding = F.col("stratum") == FINDING
    ordered = distinct.select("*", finding.cast("double").alias("target"), F.xxhash64("value", F.lit(how.seed)).alias("shard"))
    others = distinct.where(~finding).count()
    numbered = ordered.orderBy("target", "value", "stratum").rdd.zipWithIndex()  # the others, then the findings: every second of either side
    return cut(numbered.map(lambda x: (*x[0], (x[1] - (others if x[0].stratum == FINDING else 0)) % 2 == 0)).toDF(f"{WINDOW}, target double, shard long, first boolean"))


def fitted(rows: DataFrame, how: SecretScan) -> CharCnn:
    """A network trained on all the rows, towards ``target``.

    Rows are dealt by hash into shards of about ``shard_rows``. A pass trains one network per shard from the common weights, and
    the mean of these, by rows, begins the next pass. The shards depend on the number of rows alone.
    """
    net, n, share = CharCnn(seed=how.seed).start(), *rows.agg(F.count(F.lit(1)), F.avg("target")).first()
    shards = -(-n // how.shard_rows)
    passes = max(how.passes, -(-how.steps * BATCH // n))
    dealt = rows.withColumn("shard", F.pmod("shard", F.lit(shards)).cast("int"))
    names = list(net.weights)

    def trained(turn: int, steps: int | None) -> Callable[[pa.Table], pa.Table]:
        def one(group: pa.Table) -> pa.Table:
            some = sorted(zip(*(group.column(c).to_pylist() for c in ("value", "stratum", "before", "after", "target"))))
            codes, marks = encode([(before, value, after) for value, _, before, after, _ in some])
            shard = group.column("shard")[0].as_py()
            own = replace(net, weights={k: w.copy() for k, w in net.weights.items()})
            own.fit(codes, marks, np.array([x[-1] for x in some], np.float32), steps or -(-len(some) // BATCH), BATCH, share=share, turn=(turn, shard))
            flat = np.concatenate([own.weights[k].ravel() for k in names]).astype("<f4").tobytes()
            return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(some)], pa.int64()), "weights": pa.array([flat], pa.binary())})

        return one

    # a single shard makes all its steps at once
    for turn, steps in enumerate([max(how.steps, how.passes * -(-n // BATCH))] if shards == 1 else [None] * passes, 1):
        got = dealt.groupBy("shard").applyInArrow(trained(turn, steps), "shard int, n long, weights binary").collect()  # 9 KB a shard
        mean = sum(np.frombuffer(r.weights, "<f4").astype(float) * (r.n / n) for r in sorted(got))
        at = 0
        for k in names:
            w = net.weights[k]
            net.weights[k] = mean[at : at + w.size].reshape(w.shape).astype(np.float32)
            at += w.size
    return net


def scored(rows: DataFrame, net: CharCnn) -> DataFrame:
    """The rows with the network's logit of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "value"):
            for at in range(0, batch.num_rows, SCORED):
                some = batch.slice(at, SCORED)
                logits = net.logits(*encode(list(zip(*(some.column(c).to_pylist() for c in ("before", "value", "after"))))))
                yield some.append_column("logit", pa.array(logits.astype(float), pa.float64()))

    return map_batches(rows, run, f"{WINDOW}, target double, shard long, first boolean, logit double")


def calibrated(net: CharCnn, held: DataFrame, how: SecretScan) -> CharCnn:
    """``CharCnn.calibrate`` over all held-out rows: sums for each Newton step, and the finding at the threshold's rank."""
    finding, x = F.col("stratum") == FINDING, F.col("logit")
    n, found = held.agg(F.count(F.lit(1)), F.count_if(finding)).first()
    line = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), x * float(line[0]) + float(line[1])))))
        miss, bend = F.when(finding, (found + 1) / (found + 2)).otherwise(1 / (n - found + 2)) - p, p * (1 - p)
        g0, g1, h00, h01, h11 = held.agg(F.sum(miss * x), F.sum(miss), F.sum(bend * x * x), F.sum(bend * x), F.sum(bend)).first()
        move = newton(np.array([[h00, h01], [h01, h11]]), np.array([g0, g1]))
        line += move
        if np.abs(move).max() < 1e-6:
            break
    net.slope, net.shift = map(float, line)
    height = x * net.slope
    rank = int(np.floor((1 - how.min_recall) * found))
    lowest = held.where(finding).select(height.alias("height")).orderBy("height").rdd.zipWithIndex().filter(lambda r: r[1] == rank).first()[0][0]
    net.threshold = float(net.sigmoid(np.array(lowest)))
    hits, right = held.where(height >= lowest).agg(F.count(F.lit(1)), F.count_if(finding)).first()
    net.recall, net.precision = right / found, right / hits
    return net


def train(docs: DataFrame, how: SecretScan = SecretScan(), text: str = "text") -> CharCnn | None:
    """The calibrated network, or None where the corpus has no two findings or no two others."""
    rows = training_rows(docs, how, text)
    n, found = rows.agg(F.count(F.lit(1)), F.count_if(F.col("stratum") == FINDING)).first()
    if min(found, n - found) < 2:
        return None
    half, other = rows.where("first"), rows.where("not first")
    net = fitted(half, how)
    held = cut(scored(other, net))
    net = calibrated(net, held, how)
    p = 1 / (1 + F.exp(-(F.col("logit") * net.slope + net.shift)))
    p = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), p))
    c = held.where(F.col("stratum") == FINDING).agg(F.avg(p)).first()[0]
    missed = F.least(F.lit(1.0), (1 - c) / c * p / (1 - p))
    chances = held.withColumn("target", F.when(F.col("stratum") == RUN_ONLY, missed).otherwise(F.col("target"))).drop("logit")
    net = fitted(cut(chances), how)
    return calibrated(net, cut(scored(half, net)), how)


def learn(rows: list[tuple[int, str, str, str]], how: SecretScan = SecretScan()) -> CharCnn | None:
    """``train`` on rows in memory, for trials without tables; ``scan_documents`` and ``mask_documents`` do not use it."""
    order = np.random.default_rng(how.seed).permutation(len(rows))
    strata = np.array([rows[i][0] for i in order], np.int32)
    labels = (strata == FINDING).astype(np.float32)
    if min((labels == k).sum() for k in (0, 1)) < 2:
        return None
    codes, marks = encode([rows[i][1:] for i in order])
    held = np.zeros(len(order), bool)
    for k in (0, 1):  # half of either side
        held[np.flatnonzero(labels == k)[::2]] = True

    def fit(on: np.ndarray, targets: np.ndarray) -> CharCnn:
        net = CharCnn(seed=how.seed).fit(codes[on], marks[on], targets[on])
        return net.calibrate(codes[~on], marks[~on], labels[~on], how.min_recall)

    p = np.clip(fit(held, labels).probability(codes, marks), 1e-6, 1 - 1e-6)
    c = p[~held & (labels == 1)].mean()
    missed = np.clip((1 - c) / c * p / (1 - p), 0, 1).astype(np.float32)
    return fit(~held, np.where(strata == RUN_ONLY, missed, labels))


def scan(texts: list[str], net: CharCnn | None) -> list[list[Span]]:
    """Base and learned spans of each text, by start, then kind (learned last)."""
    found = [base_spans(t) for t in texts]
    if net is not None:
        runs = [(i, s, e) for i, t in enumerate(texts) for s, e in candidates(t, found[i])]
        best = np.zeros(len(runs))
        places = ((k, b) for k, (_, s, e) in enumerate(runs) for b in window_starts(s, e))
        while some := list(islice(places, SCORED)):
            scores = net.probability(*encode([window(texts[runs[k][0]], b, runs[k][2]) for k, b in some]))
            np.maximum.at(best, [k for k, _ in some], scores)
        for (i, s, e), p in zip(runs, best):
            if p >= net.threshold:
                found[i].append((LEARNED, s, e, s))
    order = (*KINDS, LEARNED)
    return [sorted(x, key=lambda s: (s[1], order.index(s[0]))) for x in found]


def masked(text: str, spans: list[Span]) -> str:
    """The text with the values of all spans replaced; values that overlap become one mask."""
    out, at = [], 0
    areas: list[list[int]] = []
    for start, end in sorted((s[3], s[2]) for s in spans):
        if areas and start < areas[-1][1]:
            areas[-1][1] = max(areas[-1][1], end)
        else:
            areas.append([start, end])
    for start, end in areas:
        out += [text[at:start], MASK]
        at = end
    return "".join(out) + text[at:]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans)


def scan_documents(docs: DataFrame, how: SecretScan = SecretScan(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_learned, base_sha256, spans, masked_chars) of every row."""
    net = train(docs, how, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = scan([x or "" for x in batch.column("text").to_pylist()], net)
            base = [[s for s in x if s[0] != LEARNED] for x in found]
            counts = [pa.array([sum(s[0] == k for s in x) for x in found], pa.int64()) for k in (*KINDS, LEARNED)]
            digests = [hashlib.sha256(joined(x).encode()).hexdigest() for x in base]
            yield pa.record_batch([batch.column("doc_id"), *counts, pa.array(digests, pa.string()), pa.array([joined(x) for x in found], pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "n_learned", "base_sha256", "spans"])

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(named, run, "doc_id long, n_assign long, n_access long, n_hex long, n_learned long, base_sha256 string, spans string")


def mask_documents(docs: DataFrame, how: SecretScan = SecretScan(), text: str = "text") -> DataFrame:
    """``docs`` with all secret values masked in the text; a null text stays null, other columns stay."""
    net = train(docs, how, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            texts = batch.column(text).to_pylist()
            found = scan([x or "" for x in texts], net)
            clean = [masked(x, s) if s else x for x, s in zip(texts, found)]
            yield batch.set_column(batch.schema.get_field_index(text), text, pa.array(clean, batch.schema.field(text).type))

    return map_batches(docs, run, docs.schema)
