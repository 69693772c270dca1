"""Spelling variants by finite-state composition.

The pairs of words at one inserted, deleted or replaced code point are those that the vocabulary's
acceptor, composed with a transducer of one edit and with the acceptor again, accepts. The
composed machine runs on the diagonal (both words alike) up to the edit and on pairs of states
behind it. To be unambiguous it edits at the first place where the words differ.

The machine is cut into partitions by the states it starts and ends in, so no task holds the whole
vocabulary. Take pairs whose shorter word has m code points, and halve m: words that first differ
behind the first half share that half, the others share the second. So a word goes to four
partitions (it is the shorter or the longer word, by first or by second half), and each pair is
accepted in just one. A partition's acceptor reads what lies between the shared beginning (the path to its
initial state) and the shared end. A partition of more than ``most_words`` words is halved
again in the same way, until all are small or only single code points differ there, which the
alphabet bounds. Partitions are rows, dealt by a shuffle and read one after another.

In a partition the words are built into a minimal acceptor (states of equal right language are
one), the composition is walked, and per word the number of near words and the best of them are returned:
no more rows than words, never the pairs.

A word's form is its near word of the most occurrences (ties: smallest in code-point order) if
that has ``ratio`` times the word's own. Occurrences grow along forms, so following them ends;
roots come from pointer doubling by equi-joins.

Defined cases: null and empty texts have no words; a null id takes part in counts like any
other (and plants nothing); repeated rows count each; runs of any length are words; words without
near words have 0 of them, no form and are their own root; an empty table gives no rows; columns
other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, splittable

#: fixed values: letters of words, and the letters that are lower-cased
LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PLACE = ("m", "head", "tail", "low", "high", "shared")
NEAR = "word string, n_near long, near_n long, near string"


@dataclass(frozen=True)
class Spelling:
    least_chars: int = 6
    least_occurrences: int = 5
    ratio: int = 5
    most_words: int = 20_000


def occurrences(docs: DataFrame, how: Spelling = Spelling(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, word) of every run of letters that is long enough; the greedy pattern matches whole runs only."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(f"[{LETTERS}]{{{how.least_chars},}}"), F.lit(0))).alias("word"))
    ascii_only = F.length("word") == F.octet_length("word")  # there lower() does just the same, faster
    return rows.withColumn("word", F.when(ascii_only, F.lower("word")).otherwise(F.translate("word", UPPER, LOWER)))


def slipped(words: DataFrame, every: int = 199) -> DataFrame:
    """Occurrences with a code point deleted from one in ``every``, by a rule over crc32 of id and word (see the contract of op13)."""
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("word")).cast("binary"))
    at = (F.col("h") % F.length("word")).cast("int")
    short = F.concat(F.substring("word", F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
    return words.withColumn("h", h).select("doc_id", F.when(F.col("h") % every == 0, short).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, how: Spelling = Spelling()) -> DataFrame:
    """(word, n) of the words that occur often enough."""
    counts = words.where(F.length("word") >= how.least_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= how.least_occurrences)


def _shared(head: Column, tail: Column) -> Column:
    """What all words of a partition begin and end with."""
    end = F.when(tail > 0, F.substring(F.col("word"), F.length("word") - tail + 1, tail)).otherwise("")
    return F.concat(F.substring(F.col("word"), F.lit(1), head), F.lit("|"), end)


def _halved(rows: DataFrame) -> DataFrame:
    """Each row in the two partitions of the halves of what is not shared yet: pairs that first differ from
    the middle on share one more half at the beginning, those that differ before share the other at the end."""
    half = F.floor((F.col("m") - F.col("head") - F.col("tail")) / 2).cast("int")
    middle = F.col("head") + half
    later = F.struct(middle.alias("head"), F.col("tail"), F.greatest("low", middle).alias("low"), F.col("high"))
    sooner = F.struct(F.col("head"), (F.col("m") - middle).cast("int").alias("tail"), F.col("low"), F.least("high", middle).alias("high"))
    parts = rows.select("word", "n", "m", F.explode(F.array(later, sooner)).alias("p")).select("word", "n", "m", "p.*")
    return parts.withColumn("shared", _shared(F.col("head"), F.col("tail")))


def partitions(words: DataFrame, how: Spelling = Spelling()) -> DataFrame:
    """(word, n, m, head, tail, low, high, shared): the word in every partition of the composition that it is in.

    ``m`` is the shorter length, ``head`` and ``tail`` are the code points shared at both ends; pairs first differ
    at a place from ``low`` to before ``high``.
    """
    length = F.length("word")
    m = F.explode(F.when(length > how.least_chars, F.array(length, length - 1)).otherwise(F.array(length))).alias("m")
    whole = words.select("word", "n", m).select("word", "n", "m", *(F.lit(x).alias(c) for c, x in (("head", 0), ("tail", 0), ("low", 0), ("high", (1 << 31) - 1))))
    parts = _halved(whole)
    while True:
        large = parts.where(F.col("m") - F.col("head") - F.col("tail") >= 2).groupBy(*PLACE).agg(F.count(F.lit(1)).alias("size"))
        large = large.where(F.col("size") > how.most_words).select(*PLACE)
        if large.isEmpty():
            return parts
        large = cut(large)
        split = _halved(parts.join(splittable(large), list(PLACE), "left_semi").drop("shared"))
        parts = cut(parts.join(splittable(large), list(PLACE), "left_anti").unionByName(split))


class Acceptor:
    """The minimal acyclic acceptor of some strings."""

    def __init__(self, strings: list[str]) -> None:
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.lengths: list[int] = []  # bit k: a string of k more code points is accepted
        known: dict[tuple, int] = {}

        def state(final: bool, arcs: dict[str, int]) -> int:
            key = (final, *arcs.items())  # arcs are in order of their code points
            at = known.get(key)
            if at is None:
                at = known[key] = len(self.arcs)
                self.arcs.append(arcs)
                self.final.append(final)
                lengths = 1 if final else 0
                for to in arcs.values():
                    lengths |= self.lengths[to] << 1
                self.lengths.append(lengths)
            return at

        # in sorted order, a path that the next string leaves is complete and meets its equal states
        path: list[tuple[bool, dict[str, int]]] = [(False, {})]
        last = ""
        for s in [*sorted(set(strings)), None]:
            keep = 0
            if s is not None:
                most = min(len(s), len(last))
                while keep < most and s[keep] == last[keep]:
                    keep += 1
            for k in range(len(last), keep, -1):
                final, arcs = path.pop()
                path[-1][1][last[k - 1]] = state(final, arcs)
            if s is not None:
                path += [(False, {}) for _ in range(len(s) - keep)]
                path[-1] = (True, path[-1][1])
                last = s
        self.start = state(*path[0])

    def common(self, p: int, q: int, length: int, without: str = "") -> Iterator[str]:
        """Strings of a length that both states accept, not beginning with ``without``."""
        arcs, final, lengths = self.arcs, self.final, self.lengths
        todo = [(p, q, length, None)]
        while todo:
            p, q, rest, path = todo.pop()
            if not rest:
                if final[p] and final[q]:
                    out = []
                    while path:
                        out.append(path[0])
                        path = path[1]
                    yield "".join(reversed(out))
                continue
            a, b = arcs[p], arcs[q]
            if len(b) < len(a):
                a, b = b, a
            rest -= 1
            for c, x in a.items():
                y = b.get(c)
                if y is not None and lengths[x] >> rest & 1 and lengths[y] >> rest & 1 and not (path is None and c == without):
                    todo.append((x, y, rest, (c, path)))

    def near(self, short: int, low: int, high: int) -> Iterator[tuple[str, str]]:
        """Accepted pairs of the composition with one edit: strings of ``short`` code points with those of as many or one
        more that first differ from ``low`` to before ``high``."""
        arcs, final, lengths = self.arcs, self.final, self.lengths
        path: list[str] = []
        todo = [(self.start, 0, "")]
        while todo:
            p, depth, c = todo.pop()
            if depth:
                path[depth - 1 :] = [c]
            out = arcs[p]
            rest = short - depth
            if low <= depth <= short and (len(out) > 1 or final[p]):
                begin = "".join(path[:depth])
                if rest:  # one code point replaced by another
                    equal = [(c, s) for c, s in out.items() if lengths[s] >> (rest - 1) & 1]
                    for i, (c, s) in enumerate(equal):
                        for d, t in equal[:i]:
                            for x in self.common(s, t, rest - 1):
                                yield begin + c + x, begin + d + x
                if lengths[p] >> rest & 1:  # one code point more in the second
                    for c, s in out.items():
                        if lengths[s] >> rest & 1:
                            for x in self.common(p, s, rest, c):
                                yield begin + x, begin + c + x
            if depth + 1 < high:
                todo += [(s, depth + 1, c) for c, s in out.items()]


def _best(words: list[str], counts: list[int], m: int, head: int, tail: int, low: int, high: int) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, occurrences of the best, the best) for the words of a partition that have any."""
    middles = {w[head : len(w) - tail]: (w, n) for w, n in zip(words, counts)}
    found: dict[str, list] = {}
    for pair in Acceptor(list(middles)).near(m - head - tail, low - head, high - head):
        for a, b in (pair, pair[::-1]):
            word, n = middles[b]
            best = found.get(a)
            if best is None:
                found[a] = [1, n, word]
            else:
                best[0] += 1
                if (-n, word) < (-best[1], best[2]):
                    best[1:] = n, word
    for a, (k, n, word) in found.items():
        yield middles[a][0], k, n, word


def near_words(words: DataFrame, how: Spelling = Spelling()) -> DataFrame:
    """(word, n_near, near_n, near): per partition the number of near words and the best one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, counts, out = None, [], [], []

        def done() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["word", "n_near", "near_n", "near"])
            out.clear()
            return batch

        for batch in batches:
            columns = batch.to_pydict()
            for at, word, n in zip(zip(*(columns[c] for c in PLACE)), columns["word"], columns["n"]):
                if at != place:
                    if len(held) > 1:
                        out += _best(held, counts, *place[:-1])
                    place, held, counts = at, [], []
                    if len(out) > 10_000:
                        yield done()
                held.append(word)
                counts.append(n)
        if len(held) > 1:
            out += _best(held, counts, *place[:-1])
        if out:
            yield done()

    dealt = partitions(words, how).repartition(*PLACE).sortWithinPartitions(*PLACE)
    return dealt.select(*PLACE, "word", "n").mapInArrow(run, NEAR)


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) rows: root is the last word that following forms leads to."""
    now = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = cut(now.join(splittable(step), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        now = after.select("word", "root")
        if after.where("moved").isEmpty():
            return now


def variants(words: DataFrame, how: Spelling = Spelling()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words (word, n)."""
    words = cut(words)
    near = near_words(words, how).withColumn("n", F.lit(None).cast("long"))
    whole = words.select("word", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("near_n"), F.lit(None).cast("string").alias("near"), "n").unionByName(near)
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near")))
    told = whole.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    good = -F.col("best.less") >= how.ratio * F.col("n")
    told = cut(told.select("word", "n", "n_near", F.when(good, F.col("best.near")).alias("form"), F.when(good, -F.col("best.less")).alias("form_n")))
    roots = rooted(told.where(F.col("form").isNotNull()))
    return told.join(splittable(roots), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
