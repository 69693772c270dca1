"""Quality rules, personal data, secrets, near-duplicates and the pipeline against brute force."""

import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import regex
import xxhash

import corpus_pipeline
from tools.compare import digest
from tripmart.llm import catalog, char_cnn, components, packing, pii, quality_rules, secret_scan, simhash
from tripmart.llm.common import table

from ..conftest import SF_MID, SF_SMALL

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("key", sorted(catalog.ORACLE_SQL))
@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_queries_match_their_sql(spark, key, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    ours, theirs = catalog.QUERIES[key](spark, sf).toPandas(), con.sql(catalog.ORACLE_SQL[key]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) == len(theirs) and digest(ours) == digest(theirs)


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def brute_measure(text):
    text = text or ""
    words = words_of(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    seen, dups, lines = set(), 0, 0
    for line in text.split("\n"):
        if words_of(line):
            lines += 1
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text) if words else 0, lines, dups, len(covered)


def test_measures(spark, edge):
    docs = [r.text for r in edge.union(table(spark, SF_SMALL, "documents").selectExpr("doc_id", "text", "lang", "source", *["null"] * 10)).collect()]
    for text in docs + ["a\x85b a\x85b a\x85b", "a b c a b c", "a a a a", "x\n\nx\n x"]:
        assert quality_rules.measure_text((text or "").encode()) == brute_measure(text)


def test_quality_edge_cases(edge, nothing):
    out = quality_rules.apply_rules(edge).collect()
    assert len(out) == edge.count() and {r.doc_id: r.kept for r in out}[1] is False
    kept = quality_rules.kept_documents(edge)
    assert kept.columns == edge.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r.doc_id) for r in out if r.kept)
    assert quality_rules.apply_rules(nothing).count() == 0 and quality_rules.kept_documents(nothing).count() == 0


def test_bad_hosts_lose_their_marginal_documents(spark):
    good = " ".join(f"w{i}" for i in range(60))
    noisy = good + " ###################"
    rows = [(i, noisy if i % 10 else good, "bad") for i in range(100)] + [(100 + i, noisy if i % 20 == 0 else good, f"h{i % 5}") for i in range(500)] + [(999, noisy, "one")]
    out = {r.doc_id: r for r in quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(out[i].kept == (text == good or host != "bad") for i, text, host in rows if host != "one")
    assert [r.bad for r in quality_rules.host_verdicts(quality_rules.measures(spark.createDataFrame(rows, "doc_id long, text string, source string"))).where("host = 'bad' and rule = 'symbols'").collect()] == [True]


def _hosts(spark, sizes):
    """Documents of hosts given as name -> (documents, those that break the symbol rule); the verdict per host."""
    good = " ".join(f"w{i}" for i in range(60))
    noisy = good + " ###################"
    rows = [(n, noisy if i < fails else good, host) for n, (host, docs, fails) in enumerate(sizes) for i in range(docs)]
    verdicts = quality_rules.host_verdicts(quality_rules.measures(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    return {r.host: r.bad for r in verdicts.where("rule = 'symbols'").collect()}


def test_a_host_is_held_against_all_others(spark):
    others = [(f"h{i}", 60, 6) for i in range(10)]
    assert [h for h, bad in _hosts(spark, [("third", 300, 180), *others]).items() if bad] == ["third"]  # a third of all rows
    many = [(f"h{i}", 60, 33) for i in range(10)]  # most documents of the corpus break the rule
    assert [h for h, bad in _hosts(spark, [("worse", 300, 285), *many]).items() if bad] == ["worse"]
    assert not any(_hosts(spark, [("alone", 100, 90)]).values())


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(number))) % 10 == 0


def brute_pii(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            number = re.sub("[^0-9]", "", m[0])
            fits = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 16 <= len(number) <= 19 and luhn(number), "phone": 8 <= len(number) <= 15}
            if fits[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


PII_TEXTS = [
    "a@b.c_d@e.f a@b a@b.c.d. @x.y 𝔘x@y.zz", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.4 1.2.3 9.9.9.9.", "10.0.0.1 0.0.0.0 00.010.0100.255 1.2.3.00256 1.2.3.0256 000.0.0.0000", "4111 1111 1111 1111 4111-1111-1111-1111-2 41111111111111111111",
    "x4111111111111111y 4111  1111 1111 1111 5-4111 1111 1111 1111", "+1 (212) 555-0153 +1234567 +12345678 +1(((((( 5 +1234567890123456 ++12345678", "é" * 10 + "+1 212 555 0153", None, "", "1" * 3000, "a" * 5000 + "@", "1.1" * 500, "a@" + "b." * 2000 + "c",
]


def test_base_spans(spark, edge):
    texts = PII_TEXTS + [r.text for r in table(spark, SF_SMALL, "documents").collect()]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.digest(pii.sanitising_spans(rows)).collect():
        want = brute_pii(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert r.spans.split(",")[: len(want)] == (want or [""])[: len(want)]
        assert {k: r[f"n_{k}"] for k in BASE} == {k: sum(x.startswith(k) for x in want) for k in BASE}


def test_disclosure_is_brute_force(spark, edge, nothing):
    rng = np.random.default_rng(8)
    words = [f"common{c}" for c in "abcdefgh"]
    texts = []
    for i in range(60):
        body = " ".join(rng.choice(words, 12))
        texts.append(f"{body} zebra me{i % 3}@x.org giraffe{'ab'[i % 2]} {body}" if i % 4 == 0 else body + (" zebra" if i % 3 == 0 else ""))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.mentions(docs)
    got = pii.disclosures(docs, found).count()
    term = {w: spark.range(1).selectExpr(f"xxhash64('{w}') as h").first().h for w in ("zebra", "giraffea", "giraffeb", *words)}
    n = len(texts)
    shares = {(r.entity, r.term): r.disclosure for r in pii.disclosures(docs, found).collect()}
    checked = 0
    for mail in ("me0@x.org", "me1@x.org", "me2@x.org"):
        entity = spark.range(1).selectExpr(f"xxhash64('email', '{mail}') as h").first().h
        with_entity = [t for t in texts if mail in t]
        for word, h in term.items():
            with_term = [t for t in texts if word in t.split()]
            near = [t for t in with_entity if word in t[max(0, t.index(mail) - 100) : t.index(mail) + len(mail) + 100].split()]
            if len({t for t in near}) >= 2:
                want = np.log2(n * len(near) / (len(with_entity) * len(with_term))) / np.log2(n / len(with_entity))
                whole = [t for t in near if re.search(rf"\b{word}\b", t[max(0, t.index(mail) - 99) : t.index(mail) + len(mail) + 99])]
                if len(whole) == len(near):
                    assert shares[entity, h] == pytest.approx(want)
                    checked += 1
    assert checked > 5 and got == len(shares)
    assert pii.sanitising_spans(edge).count() == edge.count() and pii.sanitising_spans(nothing).count() == 0


def brute_term_spans(texts, how):
    """Every document's term spans from counts over whole documents; plain Python, base spans by the contract's patterns."""
    held, words = [], []
    for t in texts:
        spans = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", t)]
        held.append(spans)
        words.append([(m.start(), m.end(), m.group().lower()) for m in regex.finditer(r"\p{L}[\p{L}\p{N}]{2,}+", t)])
    n = len(texts)
    ents, terms = [{e for *_, e in h} for h in held], [{w for *_, w in ws} for ws in words]
    df_e, df_t = Counter(e for s in ents for e in s), Counter(w for s in terms for w in s)
    both = Counter((e, w) for es, ws in zip(ents, terms) for e in es for w in ws)
    share = {p: np.log2(n * k / (df_e[p[0]] * df_t[p[1]])) / np.log2(n / df_e[p[0]]) for p, k in both.items() if k >= how.min_documents and df_e[p[0]] < n}
    out = []
    for es, spans, ws in zip(ents, held, words):
        best = {w: max((share.get((e, w), -1e9) for e in es), default=-1e9) for *_, w in ws}
        out.append([(a, b, best[w] >= how.remove_at) for a, b, w in ws if best[w] >= how.generalise_at and not any(x < b and a < y for x, y, _ in spans)])
    return out


@pytest.mark.parametrize("how", [pii.Sanitising(), pii.Sanitising(generalise_at=0.3, remove_at=0.6), pii.Sanitising(min_documents=4, generalise_at=-1.0, remove_at=0.1)])
def test_term_spans_are_brute_force(spark, how):
    """Whole documents: classes of entities with the same documents, copies, an entity in a third of all, one in every long text."""
    rng = np.random.default_rng(3)
    texts = []
    for i in range(150):
        body = list(rng.choice([f"w{chr(97 + j % 26)}{j}" for j in range(200)], 25))
        if i % 3 == 0:
            body.insert(5, "hot@all.org mine")
        if i % 7 == 0:
            body[3:3] = ["twin.a@x.org", "Twin.B@x.org", f"clan{i % 14}", "house"]  # same documents: one class
        if i % 11 == 0:
            body.append(f"me{i % 4}@y.net Émile{i % 4} émile{i % 4}")
        texts.append(" ".join(body))
    texts += [texts[21]] * 4 + ["", " ".join(f"p{j}@dir.org name{j}" for j in range(120))] + [" ".join(f"p{j}@dir.org name{j} other" for j in range(0, 120, 2))] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: [tuple(s) for s in r.term_spans] for r in pii.sanitising_spans(docs, how).collect()}
    want = brute_term_spans(texts, how)
    assert sum(map(len, want)) > 100
    assert got == dict(enumerate(want))


def test_sanitised_texts(spark, edge):
    rows = [(i, f"the owner zorro lives here a{i % 2}@x.org and {'alpha' * (i + 1)} more", i) for i in range(6)] + [(100 + i, "the owner lives here and more", i) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, changes long")
    out = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert len(out) == 56 and out[100] == rows[-1][1]
    assert all("[EMAIL]" in out[i] and "@" not in out[i] for i in range(6)) and "zorro" not in out[0] and "the owner" in out[0]
    clean = pii.sanitise(edge)
    assert clean.columns == edge.columns and clean.count() == edge.count()
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[1] is None and texts[2] == "" and "[EMAIL]" in texts[6] and "[IP]" in texts[6] and "[CARD]" in texts[8]


def terms_of(spark, texts, how=pii.Sanitising()):
    """Sanitised words of each text, with whether they are removed."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.term_spans for r in pii.sanitising_spans(docs, how).collect()}
    return [{(t[s.start : s.stop], s.remove) for s in rows[i]} for i, t in enumerate(texts)]


def test_copies_of_one_passage_are_sanitised(spark):
    signature = "common words regards zorro me@x.org office words common"
    out = terms_of(spark, [signature] * 5 + ["common words regards office"] * 60)
    assert all(x == {("zorro", True)} for x in out[:5]) and not any(out[5:])


def test_documents_are_counted_not_windows(spark):
    many = " ".join(f"common{i} me@x.org common{i} number{i} zebra" for i in range(40))
    texts = [many, "me@x.org common zebra"] + ["me@x.org"] * 8 + ["zebra common"] * 28 + ["common"] * 262
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    h = spark.range(1).selectExpr("xxhash64('email', 'me@x.org') as e", "xxhash64('zebra') as t").first()
    shares = {(r.entity, r.term): r.disclosure for r in pii.disclosures(docs, pii.mentions(docs)).collect()}
    assert shares[h.e, h.t] == pytest.approx(np.log2(300 * 2 / (10 * 30)) / np.log2(300 / 10))
    assert not any(terms_of(spark, texts))


def test_far_terms_are_sanitised_everywhere(spark):
    far = "common words here " * 20
    texts = [f"zorro {far} me@x.org zorro@y.org {far} Zorro"] * 2 + [f"common words here zorro me@x.org{i}" for i in range(3)] + ["common words here"] * 60
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.term_spans for r in pii.sanitising_spans(docs, pii.Sanitising(generalise_at=0.5)).collect()}
    for i in range(2):
        assert [(s.start, s.stop) for s in rows[i]] == [(0, 5), (len(texts[0]) - 5, len(texts[0]))]
    assert not any(rows[i] for i in range(2, 65))


def brute_secrets(text):
    assign = [("assign", m.start(), m.end()) for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII) if len(m[1]) >= 6]
    access = [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    runs = [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(assign + access + runs, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_secret_base_spans(spark, edge, nothing):
    tricky = ["secret=token : abcdefg", "PassWord = 'hunter22'", "token=secret=abcdefgh", "apikey:x api_key:'abcdef", "AKIAAKIA" + "A" * 16 + " AKIA1", "ſecret=abcdefgh", "0" * 23 + "g" + "f" * 24, "token" + " " * 3000 + "=" + " " * 3000 + "abcdef", ""]
    for text in tricky + [r.text for r in table(spark, SF_MID, "documents").collect()]:
        assert [s[:3] for s in secret_scan.base_spans(text)] == brute_secrets(text)
    out = secret_scan.scan_documents(edge).collect()
    assert len(out) == edge.count() and secret_scan.scan_documents(nothing).count() == 0
    masked = secret_scan.mask_documents(edge)
    assert masked.columns == edge.columns
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert texts[1] is None and "hunter22" not in texts[6] and texts[5] == edge.where("doc_id = 5").first().text


def test_network_finds_held_out_secrets(spark):
    rng = np.random.default_rng(9)

    def make(n, secret):
        out = []
        for _ in range(n):
            value = "".join(rng.choice(list("0123456789abcdef" if secret else "0123456789"), 40 if secret else 16))
            before = 'token = "' if secret and rng.random() < 0.5 else "plain words here "
            out.append((before, value, " and more"))
        return out

    codes, marks = char_cnn.encode(make(150, True) + make(150, False))
    labels = np.array([1] * 150 + [0] * 150, np.float32)
    train, held = np.arange(300) % 2 == 0, np.arange(300) % 2 == 1
    net = char_cnn.CharCnn().fit(codes[train], marks[train], labels[train], steps=400)
    net.calibrate(codes[held], marks[held], labels[held], 0.95, 0.95)
    new_codes, new_marks = char_cnn.encode(make(100, True) + make(100, False))
    hit = net.probability(new_codes, new_marks) >= net.threshold
    assert hit[:100].mean() >= 0.85 and hit[100:].mean() <= 0.02


def sample_of_secrets(n, missed):
    """Findings, as many unmatched runs (the last ``missed`` look like the findings) and plain words."""
    rng = np.random.default_rng(11)

    def of(letters, size):
        return "".join(rng.choice(list(letters), size))

    hexes = [of("0123456789abcdef", 40) for _ in range(n + missed)]
    rows = [(secret_scan.FINDING, "some words ", v, " and more") for v in hexes[:n]] + [(secret_scan.PLAIN, "some words ", of("etaoinsh", 14), " and more") for _ in range(n)]
    return rows + [(secret_scan.RUN_ONLY, "some words ", of("0123456789", 16), " and more") for _ in range(n - missed)] + [(secret_scan.RUN_ONLY, "some words ", v, " and more") for v in hexes[n:]]


def test_network_is_trained_on_every_value(spark):
    rng = np.random.default_rng(3)
    texts = [f"some words {secret_scan.KEYWORDS[i % 4]} = {''.join(rng.choice(list('0123456789abcdef'), 20))} and run{i:05d}x more" for i in range(1800)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = secret_scan.training_rows(docs).collect()
    want = {(s, w[1]) for s, *w in secret_scan._labelled(iter(texts), secret_scan.SecretScan())}
    assert {(r.stratum, r.value) for r in rows} == want and len(rows) == len(want)  # far more than 1,500 of a stratum
    for side in (True, False):
        halves = [r.first for r in rows if (r.stratum == secret_scan.FINDING) == side]
        assert abs(2 * sum(halves) - len(halves)) <= 1
    how = secret_scan.SecretScan(shard_rows=400, steps=200)  # several shards
    net = secret_scan.train(docs, how)
    codes, marks = char_cnn.encode([(r.before, r.value, r.after) for r in rows])
    labels = np.array([r.stratum == secret_scan.FINDING for r in rows], np.float32)
    held = np.array([r.first for r in rows])
    by_hand = char_cnn.CharCnn(weights=net.weights).calibrate(codes[held], marks[held], labels[held], how.min_recall)
    assert (net.recall, net.precision) == pytest.approx((by_hand.recall, by_hand.precision), abs=2e-3)
    assert (net.slope, net.shift, net.threshold) == pytest.approx((by_hand.slope, by_hand.shift, by_hand.threshold), rel=1e-2)
    assert net.recall >= 0.95 and net.precision >= 0.95


@pytest.mark.parametrize("n, missed", [(100, 40), (8, 0)])
def test_missed_and_few_findings_do_not_stop_the_network(n, missed):
    rows = sample_of_secrets(n, missed)
    net = secret_scan.learn(sorted(rows))
    assert net is not None and net.threshold <= 1 and net.recall >= 0.95
    hit = net.probability(*char_cnn.encode([r[1:] for r in rows])) >= net.threshold
    assert hit[:n].mean() >= 0.8 and hit[2 * n : 3 * n - missed].mean() <= 0.05
    assert not missed or hit[-missed:].mean() >= 0.6


def test_whole_runs_are_candidates():
    def found(text):
        return [text[s:e] for s, e in secret_scan.candidates(text, secret_scan.base_spans(text))]

    assert found("some plainwords Capital SHOUTED well-known either/or ====== " + "ab" * 3) == []
    assert found("short a1b2c3 camelCase KEYlowerKEY " + "q" * 60) == ["a1b2c3", "camelCase", "KEYlowerKEY", "q" * 60]
    assert found("see ABCD" + "0123456789abcdef" * 2 + "XYZ9 end") == ["ABCD", "XYZ9"]


def test_long_runs_are_scored_to_their_end():
    class SeesK:
        threshold = 0.5

        def probability(self, codes, marks):
            return ((codes == ord("K")) & (marks == 1)).any(axis=1).astype(float)

    for at in (0, 47, 48, 100, 119):
        run = "z1/" * 40
        run = run[:at] + "K" + run[at + 1 :]
        assert secret_scan.scan([f"some words {run} and more"], SeesK()) == [[(secret_scan.LEARNED, 11, 131, 11)]]
    assert secret_scan.scan([f"some words {'z1/' * 40} Keep"], SeesK()) == [[]]
    for size in (1, 48, 49, 72, 73, 500):
        starts = char_cnn.window_starts(7, 7 + size)
        assert starts[0] == 7 and starts[-1] == 7 + max(0, size - char_cnn.VALUE) and max(np.diff(starts), default=0) <= char_cnn.VALUE // 2


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    codes, marks = char_cnn.encode([("ab ", "x1y2", " c"), ("", "zz", "q")])
    net = char_cnn.CharCnn(channels=3, filters=4).fit(codes, marks, np.array([1, 0], np.float32), steps=1)
    before = net.logits(codes, marks)
    for _ in range(30):
        net.fit(codes, marks, np.array([1, 0], np.float32), steps=int(rng.integers(20, 40)))
    after = net.logits(codes, marks)
    assert after[0] - after[1] > before[0] - before[1] and after[0] > 0 > after[1]


def brute_fingerprint(text, size=4):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius=4):
    fps = sorted(set(fps))
    up = {f: f for f in fps}

    def find(f):
        while up[f] != f:
            f = up[f]
        return f

    values = np.array(fps, np.uint64)
    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= radius):
            up[find(fps[i + 1 + j])] = find(f)
    return {f: find(f) for f in fps}


def check_near_duplicates(rows, out):
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    root = brute_components([f for _, f in fps])
    low = {}
    for i, f in fps:
        if i is not None:
            low[root[f]] = min(i, low.get(root[f], i))
    want = sorted(((i, f - (1 << 64) if f >> 63 else f, low.get(root[f])) for i, f in fps), key=str)
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in out), key=str) == want


def test_near_duplicates(spark, edge, nothing):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    check_near_duplicates(rows, simhash.near_duplicates(edge).collect())
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.one_of_each(nothing).count() == 0
    docs = table(spark, SF_MID, "documents")
    check_near_duplicates([(r.doc_id, r.text) for r in docs.collect()], simhash.near_duplicates(docs, tile_rows=40).collect())
    kept = simhash.one_of_each(edge)
    assert kept.columns == edge.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "5", "6", "7", "8", "None"]


def test_tiles_find_every_link():
    rng = np.random.default_rng(10)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = np.array([c ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False))) for c in centres for _ in range(60)], np.uint64)
    values = np.unique(np.concatenate((near, rng.integers(0, 1 << 63, 1500, dtype=np.uint64))))
    rng.shuffle(values)
    want = brute_components(values.tolist())

    def groups(u, v, nodes):
        up = {n: n for n in nodes}

        def find(n):
            while up[n] != n:
                n = up[n]
            return n

        for a, b in zip(u.tolist(), v.tolist()):
            assert a != b
            up[find(a)] = find(b)
        out = {}
        for n in nodes:
            out.setdefault(find(n), set()).add(n)
        return sorted(map(sorted, out.values()))

    of_want = {}
    for n, r in want.items():
        of_want.setdefault(r, set()).add(n)
    assert groups(*simhash.tile_links(values, None), values.tolist()) == sorted(map(sorted, of_want.values()))
    one, two = values[:1500], values[1500:]
    parts = [simhash.tile_links(one, None), simhash.tile_links(two, None), simhash.tile_links(one, two)]
    u, v = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    assert groups(u, v, values.tolist()) == sorted(map(sorted, of_want.values()))
    assert len(parts[2][0]) < len(values)


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(0, 70)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    rows = chain + hub + [(5, 5), (None, 3), (2000, 2001), (2001, 2000), (2000, 2001)]
    out = {r.node: r.root for r in components.star_components(spark.createDataFrame(rows, "u long, v long")).collect()}
    assert out == {**{i: 0 for i in range(71)}, **{1000 + i: 1000 for i in range(300)}, 2000: 2000, 2001: 2000}
    assert components.star_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_pipeline_is_brute_force(spark, edge):
    docs = table(spark, SF_SMALL, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    verdict = {r.doc_id: r.kept for r in quality_rules.apply_rules(docs).collect()}
    base = {i: brute_measure(r.text) for i, r in rows.items()}
    kept = [i for i, m in base.items() if m[0] >= 50 and 100 * m[5] <= 50 * m[0]]
    assert {i for i, k in verdict.items() if k} <= set(kept)
    kept = [i for i in kept if verdict[i]]
    fps = {i: brute_fingerprint(rows[i].text) for i in kept}
    root = brute_components(fps.values())
    first = {}
    for i in sorted(kept):
        first.setdefault(root[fps[i]], i)
    texts = {i: secret_scan.masked(rows[i].text, secret_scan.base_spans(rows[i].text)) for i in first.values()}
    from tokenizers import Tokenizer

    tokens = Tokenizer.from_file(packing.Packing().tokenizer)
    got = {}
    for p in corpus_pipeline.run(spark, SF_SMALL).collect():
        got.setdefault(p.doc_id, {})[p.start] = p.ids
    assert {i: sum((x for _, x in sorted(parts.items())), []) for i, parts in got.items()} == {i: [*tokens.encode(t, add_special_tokens=False).ids, 2] for i, t in texts.items()}


def test_pipeline_stages_take_edge_cases(spark, edge, nothing):
    for docs in (edge, nothing):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, SF_SMALL)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert after.columns == docs.columns
                docs = after
        assert after.count() >= 0
