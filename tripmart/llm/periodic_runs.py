"""Periodic run detection by online dyadic square catching.

Words arrive one after another. For every power of two b, each completed block of b words
becomes a catcher. A square of period q, 2b <= q < 4b, holds in its first half a whole block,
which comes back q words later; so each appended word compares the suffix of b words that it
completes with just the two catchers that lie 2b to 4b words back (at b = 1 also with the
word before it, for period 1). Suffixes are compared by 64-bit names, a name of 2b words being
made of the two names of its halves. A catch is a piece of a square; catches of the same period in
neighbouring blocks are the squares that merge into one run. When the runs are asked for, each
merged chain is compared word by word from one block before it to one block after it, which
gives the exact ends of the run and undoes any chance equality of names.

A stretch of period q whose smallest period is smaller is the run of that smaller period,
which a lower level has found, so chains that lie within a known run are left out.

Words are appended in chunks, which are numpy steps over all words of the chunk; the result
does not depend on the chunks. Documents of similar length share one stream, parted by words
that equal no other, so a level is kept only for documents that are long enough for it.
Names are kept for the last block of each level and for the catchers (about two per word).

A run is a stretch of words with smallest period q that cannot be extended, of at least
``least_words`` words and ``least_periods`` periods (3 or more).

Defined cases: a null or empty text has no words, no runs and an empty collapsed text; every
input row gives one row, repeated ids included; a null id is carried; texts of any length are
read whole (one text is held by one task); an empty table gives no rows; columns other than id
and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_binary, free, slices

#: words of an append inside the operator
CHUNK_WORDS = 1 << 16
LEFT, RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
RUNS = "array<struct<start:long,length:long,period:long>>"
#: fixed values of the word separators
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Repeats:
    least_words: int = 6
    least_periods: int = 4


def _named(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of pairs of names."""
    x = left * LEFT + right * RIGHT
    return x ^ (x >> np.uint64(29))


def _spread(lengths: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each n of the lengths, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


class _Level:
    """Catchers of the blocks of ``size`` words."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.count = 0  # suffixes named so far
        self.tail = np.zeros(0, np.uint64)  # names of the last ``size`` of them
        self.catchers = np.zeros(0, np.uint64)  # names of completed blocks, the oldest ``gone`` forgotten
        self.gone = 0
        self.chains: list[np.ndarray] = []  # rows of period, first block, end block

    def advance(self, names: np.ndarray) -> np.ndarray:
        """Compares new suffixes with their catchers; returns the new names of the next level."""
        b, first = self.size, self.count
        at = np.arange(first, first + len(names))
        block = at // b
        self.catchers = np.concatenate((self.catchers, names[-first % b :: b]))
        caught = []
        for back in (1, 2, 3) if b == 1 else (2, 3):
            to = block - back
            known = int(np.searchsorted(to, self.gone))  # blocks before the first word are none
            hit = known + np.flatnonzero(names[known:] == self.catchers[to[known:] - self.gone])
            if len(hit):
                caught.append(np.stack((at[hit] - to[hit] * b, to[hit])))
        if caught:
            period, catcher = np.concatenate(caught, axis=1)
            order = np.lexsort((catcher, period))
            period, catcher = period[order], catcher[order]
            new = np.flatnonzero(np.concatenate(([True], (np.diff(period) != 0) | (np.diff(catcher) != 1))))
            self.chains.append(np.stack((period[new], catcher[new], catcher[np.append(new[1:], len(order)) - 1] + 1)))
        self.count += len(names)
        keep = max(0, self.count // b - 4)  # no later suffix meets older catchers
        if keep - self.gone > 4096:
            self.catchers, self.gone = self.catchers[keep - self.gone :], keep
        both = np.concatenate((self.tail, names))
        self.tail = both[-b:].copy()
        return _named(both[:-b], both[b:]) if len(both) > b else np.zeros(0, np.uint64)

    def merged(self) -> np.ndarray:
        """Chains of neighbouring catches (period, first block, end block), whatever the appends that found them."""
        if not self.chains:
            return np.zeros((3, 0), np.int64)
        period, first, end = np.concatenate(self.chains, axis=1)
        order = np.lexsort((first, period))
        period, first, end = period[order], first[order], end[order]
        new = np.flatnonzero(np.concatenate(([True], (period[1:] != period[:-1]) | (first[1:] != end[:-1]))))
        self.chains = [np.stack((period[new], first[new], end[np.append(new[1:], len(order)) - 1]))]
        return self.chains[0]


class SquareCatchers:
    """Runs of a growing sequence of word numbers; no stretch between unequal separators has more than ``longest`` words."""

    def __init__(self, longest: int, how: Repeats = Repeats()) -> None:
        if how.least_periods < 3:
            raise ValueError("runs of fewer than three periods are not supported")
        self.how = how
        self.words: list[np.ndarray] = []
        self.levels = [_Level(1)]
        while how.least_periods * 4 * self.levels[-1].size <= longest:
            self.levels.append(_Level(2 * self.levels[-1].size))

    def append(self, words: np.ndarray) -> None:
        self.words.append(words)
        names = words.astype(np.uint64) * LEFT
        names ^= names >> np.uint64(29)
        for level in self.levels:
            if not len(names):
                break
            names = level.advance(names)

    def _stretches(self, words: np.ndarray, begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Long enough runs (start, end, period) of word positions begin to end, compared with those a period later."""
        size = np.maximum(end - begin, 0)
        within = _spread(size)
        at = within + np.repeat(begin, size)
        alike = words[at] == words[at + np.repeat(period, size)]
        first = alike & ((within == 0) | ~np.concatenate(([False], alike[:-1])))
        last = alike & np.concatenate(((within == 0)[1:] | ~alike[1:], [True]))[: len(alike)]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last)
        q = np.repeat(period, size)[starts]
        length = ends - starts + 1 + q
        good = (length >= self.how.least_words) & (length >= self.how.least_periods * q)
        starts, q, length = starts[good], q[good], length[good]
        return np.unique(np.stack((at[starts], at[starts] + length, q)), axis=1)

    def runs(self) -> np.ndarray:
        """(start, end, period) of every run so far, by start and period."""
        words = np.concatenate(self.words) if self.words else np.zeros(0, np.int64)
        self.words = [words]
        known = np.zeros((3, 0), np.int64)
        for level in self.levels:
            b = level.size
            chains = level.merged()
            for periods in ((1, 1), (2, 3)) if b == 1 else ((2 * b, 4 * b - 1),):
                period, first, end = chains[:, (chains[0] >= periods[0]) & (chains[0] <= periods[1])]
                enough = (end - first) * b >= (self.how.least_periods - 1) * period - 2 * b + 2
                period, begin, stop = period[enough], first[enough] * b, end[enough] * b
                if known.shape[1] and len(begin):
                    reach = np.maximum.accumulate(known[1])
                    before = np.searchsorted(known[0], begin, "right") - 1
                    new = (before < 0) | (reach[np.maximum(before, 0)] < stop + period)
                    period, begin, stop = period[new], begin[new], stop[new]
                found = self._stretches(words, np.maximum(begin - b, 0), np.minimum(stop + b, len(words) - period), period)
                old = set(zip(known[0].tolist(), known[1].tolist()))
                new = np.array([x not in old for x in zip(found[0].tolist(), found[1].tolist())], bool)
                known = np.concatenate((known, found[:, new]), axis=1)
                known = known[:, np.lexsort((known[2], known[0]))]
        return known


def runs_of(rows: list[np.ndarray], how: Repeats = Repeats(), chunk: int = CHUNK_WORDS) -> list[np.ndarray]:
    """(start, end, period) arrays of each sequence of word numbers (0 or more)."""
    none = np.zeros((3, 0), np.int64)
    out = [none] * len(rows)
    least = max(how.least_words, how.least_periods)
    classes: dict[int, list[int]] = {}
    for r, words in enumerate(rows):
        if len(words) >= least:
            classes.setdefault(len(words).bit_length(), []).append(r)
    parting = max((int(words.max()) for words in rows if len(words)), default=0) + 1
    for members in classes.values():
        sizes = np.array([len(rows[r]) for r in members])
        stream = np.concatenate([x for k, r in enumerate(members) for x in (rows[r], np.array([parting + k]))]).astype(np.int64)
        catchers = SquareCatchers(int(sizes.max()), how)
        step = max(chunk, int(sizes.max()))
        for at in range(0, len(stream), step):
            catchers.append(stream[at : at + step])
        found = catchers.runs()
        begins = np.cumsum(sizes + 1) - sizes - 1
        of = np.searchsorted(begins, found[0], "right") - 1
        found[:2] -= begins[of]
        cuts = np.searchsorted(of, np.arange(len(members) + 1))
        for k, r in enumerate(members):
            out[r] = found[:, cuts[k] : cuts[k + 1]]
    return out


def kept(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay: those that are in no run, or only within first periods."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[0] + runs[2], 1)
    np.add.at(change, runs[1], -1)
    return np.cumsum(change[:-1]) == 0


def _numbered(texts: pa.Array) -> list[np.ndarray]:
    """The words of each text as numbers; equal words have equal numbers."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = lists.flatten().dictionary_encode()
    numbers = coded.indices.to_numpy()
    empty = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    real = numbers != empty  # white space at an end of a text makes an empty word
    bounds = np.concatenate(([0], np.cumsum(real)))[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    numbers = numbers[real]
    return [numbers[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def periodic_runs(docs: DataFrame, how: Repeats = Repeats(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs by start and period, collapsed): collapsed is the text without the words
    that any run holds after its first period, joined by single spaces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = _numbered(batch.column("text"))
            found = runs_of(rows, how)
            collapsed = []
            for raw, runs in zip(as_binary(batch.column("text")), found):
                words = (raw or b"").split()  # six ASCII separators only
                collapsed.append(b" ".join(compress(words, kept(len(words), runs).tolist()) if runs.shape[1] else words))
            every = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
            fields = [pa.array(every[0]), pa.array(every[1] - every[0]), pa.array(every[2])]
            ends = np.cumsum([0, *(x.shape[1] for x in found)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, names=["start", "length", "period"]))
            columns = [batch.column("doc_id"), pa.array([len(x) for x in rows], pa.int64()), lists, pa.array(collapsed, pa.binary()).cast(pa.string())]
            yield pa.record_batch(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return named.mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def planted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with repeats planted in about a tenth of them, by a rule over crc32 of the id (see the
    contract of op11); the others, those without words and those without id are as they were."""
    words, h, n, a, p = free(docs, "words", "h", "n", "a", "p")
    of = docs.withColumn(h, F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")))
    of = of.withColumn(words, F.when(F.col(h) % 10 == 0, F.regexp_extract_all(text, F.lit(WORD), F.lit(0))))
    g = F.floor(F.col(h) / 10)
    of = of.withColumn(n, F.size(words).cast("long")).withColumn(a, g % F.when(F.col(n) > 0, F.col(n)))
    of = of.withColumn(p, 1 + F.floor((F.col(n) - F.col(a)) / (3 + g % 8)))
    repeated = F.flatten(F.array_repeat(F.slice(words, (F.col(a) + 1).cast("int"), F.col(p).cast("int")), F.ceil((F.col(n) - F.col(a)) / F.col(p)).cast("int")))
    whole = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), F.col(a).cast("int")), repeated), F.lit(1), F.col(n).cast("int")), " ")
    return of.withColumn(text, F.when(F.col(n) > 0, whole).otherwise(F.col(text))).select(docs.columns)


def _best(runs: Column) -> Column:
    """The run of greatest length / period; of equal ones the first."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    longer = lambda best, x: x["length"] * best["period"] > best["length"] * x["period"]
    return F.aggregate(runs, none, lambda best, x: F.when(best.isNull() | longer(best, x), x).otherwise(best))


def digest(found: DataFrame) -> DataFrame:
    """Counts, the run of the greatest exponent, and hashes of all runs and of the collapsed text."""
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    best = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), _best(F.col("runs")).alias("best"), lines.alias("lines"), "collapsed")
    return best.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join("lines", "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
