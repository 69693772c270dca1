"""Periodic runs, line dedup and spelling variants against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tripmart.llm import catalog, line_dedup, periodic_runs, spelling
from tripmart.llm.common import table

from ..conftest import SF_SMALL

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_runs(words, least_words=6, least_periods=4):
    """Maximal stretches per period, without those that a smaller period gives."""
    n, found = len(words), {}
    for q in range(1, n // least_periods + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least_words, least_periods * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((a, b, q) for (a, b), q in found.items())


def some_words(rng):
    """Words with nested and neighbouring repeats."""
    kinds = rng.randint(1, 4)
    out = []
    while len(out) < rng.randint(1, 160):
        part = [rng.randrange(kinds) for _ in range(rng.randint(1, 9))]
        if rng.random() < 0.3:
            part = part * rng.randint(2, 5) + [rng.randrange(kinds)]
        out += part * rng.choice((1, 1, 2, 4, 5, 9)) + part[: rng.randint(0, len(part))]
    return out


def test_runs_are_brute_force():
    rng = random.Random(11)
    rows = [some_words(rng) for _ in range(400)] + [[], [1], [1] * 5, [1] * 6, [1] * 700, [1, 2] * 4, list(range(50)) * 4, (list(range(33)) + [0] * 40) * 5]
    for got, words in zip(periodic_runs.runs_of([np.array(x, np.int64) for x in rows]), rows):
        assert list(zip(*got.tolist())) == brute_runs(words)


@pytest.mark.parametrize("chunk", [1, 2, 7, 64])
def test_runs_do_not_depend_on_the_appends(chunk):
    rng = random.Random(chunk)
    for _ in range(40):
        words = some_words(rng)
        catchers = periodic_runs.SquareCatchers(len(words))
        for at in range(0, len(words), chunk):
            catchers.append(np.array(words[at : at + chunk]))
            if at % 5 == 0:
                assert list(zip(*catchers.runs().tolist())) == brute_runs(words[: at + chunk])
        assert list(zip(*catchers.runs().tolist())) == brute_runs(words)


def test_equal_names_of_unequal_words_do_no_harm(monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(periodic_runs, "_named", lambda left, right: (left + right) % np.uint64(3))
    rows = [some_words(rng) for _ in range(60)]
    for got, words in zip(periodic_runs.runs_of([np.array(x, np.int64) for x in rows]), rows):
        assert list(zip(*got.tolist())) == brute_runs(words)


def test_other_bounds():
    rng = random.Random(6)
    for _ in range(60):
        words = some_words(rng)
        how = periodic_runs.Repeats(least_words=3, least_periods=3)
        assert list(zip(*periodic_runs.runs_of([np.array(words)], how)[0].tolist())) == brute_runs(words, 3, 3)


def brute_row(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    dropped = {i for a, b, q in runs for i in range(a + q, b)}
    best = None
    for a, b, q in runs:
        if best is None or (b - a) * best[2] > best[1] * q:
            best = (a, b - a, q)
    text_of = "".join(f"{a},{b - a},{q}\n" for a, b, q in runs)
    hashes = [hashlib.sha256(x.encode()).hexdigest() for x in (text_of, " ".join(w for i, w in enumerate(words) if i not in dropped))]
    return (doc_id, len(runs), *(best or (None, None, None)), None if best is None else 1000 * best[1] // best[2], *hashes)


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_runs_of_documents_are_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents").where("length(text) < 9000")
    want = sorted(brute_row(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    out = periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.planted(docs)))
    assert out.columns == COLUMNS
    assert sorted(tuple(r) for r in out.collect()) == want
    assert sum(x[1] > 0 for x in want) > len(want) // 20
    whole = catalog.op11_periodic_runs(spark, SF_SMALL)
    assert whole.columns == COLUMNS and whole.count() == table(spark, SF_SMALL, "documents").count()


def test_runs_edge_cases(spark, edge, nothing):
    out = periodic_runs.digest(periodic_runs.periodic_runs(edge)).collect()
    assert len(out) == edge.count()
    by_id = {r.doc_id: r for r in out}
    nothing_hash = hashlib.sha256(b"").hexdigest()
    assert by_id[1].n_runs == by_id[2].n_runs == by_id[4].n_runs == 0 and by_id[1].collapsed_sha256 == nothing_hash == by_id[1].runs_sha256
    assert (by_id[3].start, by_id[3].length, by_id[3].period, by_id[3].exponent_milli) == (0, 120, 6, 20_000)
    assert by_id[3].collapsed_sha256 == hashlib.sha256(b"one two three four five six").hexdigest()
    assert by_id[5].period == 97 * 13 * 3  # three words a line
    planted = periodic_runs.planted(edge)
    assert planted.columns == edge.columns and planted.count() == edge.count()
    ids = spark.createDataFrame([(i, "a b  c\td " * 6, None if i % 2 else "x") for i in range(300)], "doc_id long, text string, words string")
    want = {i: brute_row(i, "a b  c\td " * 6) for i in range(300)}
    got = periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.planted(ids))).collect()
    assert {r.doc_id: tuple(r) for r in got} == want
    assert periodic_runs.periodic_runs(periodic_runs.planted(nothing)).count() == 0


def brute_lines(rows, least_chars=40, least_documents=5):
    """(doc_id, lines, dropped, kept text) of (doc_id, text) rows."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(lower)
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= least_chars:
                holders.setdefault(key(line), set()).add(doc_id)
    last = {k: max(ids) for k, ids in holders.items() if len(ids) >= least_documents}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def line_rows():
    rng = random.Random(12)
    long = [f"shared line {i} of some forty characters and more" for i in range(12)]
    edges = ["É" * 40, "é" * 40, "x" * 39, "X" * 39 + " ", "X" * 40, " \t" + "x" * 40 + "\x0b\r", "\u00a0" + "y" * 39, "\u00a0" + "Y" * 39, "K" * 40, "\u212a" * 40]
    rows = []
    for i in range(120):
        lines = [rng.choice(long).title() if rng.random() < 0.3 else rng.choice(long + edges + ["", " ", "short"]) for _ in range(rng.randint(0, 9))]
        rows.append((rng.choice((i, i, 7, None)), "\n".join(lines)))
    return rows + [(3000, None), (3001, ""), (3002, "\n\n"), (3003, "\n".join(long * 3)), (3003, "\n".join(long * 3)), (3004, "\n".join(f"line {i:040d}" for i in range(20_000)))]


@pytest.mark.parametrize("batches, fanout", [(1, 2), (4, 2), (7, 3)])
def test_lines_are_brute_force(spark, batches, fanout):
    rows = line_rows()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lines string, dropped int")
    out = line_dedup.without_lines(docs, line_dedup.Lines(batches=batches, fanout=fanout, buckets=3))
    assert out.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert sorted((tuple(r) for r in line_dedup.digest(out).collect()), key=str) == brute_lines(rows)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run")]


def test_settled_lines_are_not_written_again(spark):
    index = line_dedup.LineRuns(spark, line_dedup.Lines(fanout=3, buckets=2))
    for batch in range(5):
        docs = [(100 - batch * 10 - d, 1, 1) for d in range(10)] + [(100 - batch * 10, 2, batch)]
        index.add(spark.createDataFrame(docs, "doc_id long, h1 long, h2 long"))
    assert [len(level) for level in index.levels] == [2, 1]
    held = sum(spark.table(n).where("h1 = 1").count() for n in index.runs())
    assert held == 1  # frequent after the first batch
    assert [tuple(r) for r in index.frequent().collect()] == [(1, 1, 100)]
    index.close()


def test_runs_of_lines_merge_without_a_shuffle(spark):
    index = line_dedup.LineRuns(spark, line_dedup.Lines(fanout=9, buckets=2))
    for batch in range(2):
        index.add(spark.createDataFrame([(9 - batch, 1, 1)], "doc_id long, h1 long, h2 long"))
    plan = index._merge(index.runs())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan, plan
    index.close()


def test_lines_edge_cases(edge, nothing):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    out = line_dedup.without_lines(edge)
    assert out.columns == [*edge.columns, "n_lines", "n_dropped"]
    assert sorted((tuple(r) for r in line_dedup.digest(out).collect()), key=str) == brute_lines(rows)
    assert line_dedup.without_lines(nothing).count() == 0


def brute_near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b))) if len(b) == len(a) + 1 else False


def brute_variants(counts, ratio=5):
    """Near words by shared deletions, each pair checked by its definition."""
    holders = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            holders[w[:i] + w[i + 1 :]].add(w)
        holders[w].add(w)
    near = defaultdict(set)
    for some in holders.values():
        for a in some:
            near[a] |= {b for b in some if brute_near(a, b)}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out)


def some_vocabulary(rng, n, letters="abÀé"):
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 9))) for _ in range(n)]
    for _ in range(n):
        w = rng.choice(words)
        i = rng.randrange(len(w))
        words.append(rng.choice((w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1 :], w[:i] + "z" + w[i + 1 :])))
    return {w: rng.choice((5, 6, 25, 30, 125, 700, 4000)) for w in words if len(w) >= 6}


def test_acceptor_is_minimal_and_finds_all_pairs():
    rng = random.Random(13)
    for _ in range(60):
        strings = sorted({"".join(rng.choice("abc") for _ in range(rng.choice((4, 4, 5)))) for _ in range(rng.randint(1, 60))})
        machine = spelling.Acceptor(strings)
        rights = {s[i:] for s in strings for i in range(len(s) + 1)}
        languages = {frozenset(x[len(p) :] for x in strings if x.startswith(p)) for s in strings for p in (s[:i] for i in range(len(s) + 1))}
        assert len(machine.arcs) == len(languages) and rights
        for low, high in ((0, 99), (2, 99), (0, 2), (1, 3)):
            first = lambda a, b: next((i for i in range(4) if a[i] != b[i]), 4)
            want = sorted(tuple(sorted((a, b))) for a in strings for b in strings if a < b and min(len(a), len(b)) == 4 and brute_near(a, b) and low <= first(*sorted((a, b), key=len)) < high)
            assert sorted(tuple(sorted(x)) for x in machine.near(4, low, high)) == want


@pytest.mark.parametrize("most_words", [20_000, 6])
def test_variants_are_brute_force(spark, most_words):
    counts = some_vocabulary(random.Random(most_words), 700)
    counts |= {"x" * 3000: 5, "x" * 3001: 25, "x" * 2999 + "y": 125, "aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.variants(words, spelling.Spelling(most_words=most_words))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(tuple(r) for r in got.collect()) == brute_variants(counts)
    assert any(x[1] != x[2] and x[1] for x in brute_variants(counts))


def brute_words(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            w = run.translate(lower)
            h = None if doc_id is None else zlib.crc32(f"{doc_id}:{w}".encode())
            if h is not None and h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def test_variants_of_documents_are_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    counts = brute_words([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    want = brute_variants(counts)
    assert sorted(tuple(r) for r in catalog.op13_spelling_variants(spark, SF_SMALL).collect()) == want
    assert sum(x[1] is not None for x in want) > 10


def test_variants_edge_cases(spark, edge, nothing):
    docs = edge.unionByName(spark.createDataFrame([(i, "Straße ÀBCDEF àbcdef abcdef Abcdefg wordly x" * 3) for i in range(60)], "doc_id long, text string"), allowMissingColumns=True)
    found = spelling.variants(spelling.vocabulary(spelling.slipped(spelling.occurrences(docs))))
    counts = brute_words([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted(tuple(r) for r in found.collect()) == brute_variants(counts)
    assert spelling.variants(spelling.vocabulary(spelling.slipped(spelling.occurrences(nothing)))).count() == 0
