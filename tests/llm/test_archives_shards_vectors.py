"""WARC archives, shards and top-k search against brute force."""

import base64
import hashlib
from collections import defaultdict

import numpy as np
import pyarrow.fs as pafs
import pytest

from tripmart.llm import sharding, topk, warc
from tripmart.llm.common import importable

PAGES = [
    (1, "https://www.Example.com:443/a?b=C#x", "<p>one</p>"),
    (2, "http://example.com/a", "<p>one</p>"),
    (9, "http://m.example.org/", "<p>one</p>"),
    (9, "http://m.example.org/", "<p>one</p>"),
    (3, None, None),
    (4, "not a url\r\nat all", ""),
    (5, "http://example.com/é ü", "é" * 70_000),
    (None, "http://example.com/none", "<p>one</p>"),
    (None, "http://[bad/none", "<p>alone</p>"),
    (6, "http://example.com/6", "\r\n\r\nWARC/1.0\r\n\r\n"),
]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def wanted(pages, min_bytes=0):
    top = {}
    for page, _, html in pages:
        if page is not None:
            top[html or ""] = max(page, top.get(html or "", page))
    out = []
    for page, _, html in pages:
        first = top.get(html or "")
        revisit = first is not None and (page is None or page < first) and len((html or "").encode()) >= min_bytes
        out.append((page, len((html or "").encode()), digest(html), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 11])
def test_archives_read_back(spark, tmp_path, min_bytes):
    importable(spark)
    pages = spark.createDataFrame([(*p, 7, "x") for p in PAGES], "page_id long, url string, html string, payload long, first string").repartition(3)
    how = warc.WarcOptions(min_revisit_bytes=min_bytes, archive_bytes=500, captures_per_range=3)
    out = warc.archive_pages(pages, f"file://{tmp_path}/archives", how).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out), key=str) == wanted(PAGES, min_bytes)
    out.sort(key=lambda r: (r.range_id, r.place))
    keys = [warc.sort_key(tuple(r[c] for c in warc.NAMES)) for r in out]
    assert keys == sorted(keys) and len({r.range_id for r in out}) > 1
    for r in out:  # each record can be read alone, at its offset
        fs, name = pafs.FileSystem.from_uri(r.archive)
        with fs.open_input_file(name) as f:
            f.seek(r.record_offset)
            ((_, size, raw),) = warc.members([f.read(r.record_length)])
        assert size == r.record_length and f"WARC-Type: {r.record_type}" in raw[:200].decode()


def test_empty_pages_and_pages_of_nulls(spark, tmp_path):
    schema = "page_id long, url string, html string"
    assert warc.archive_pages(spark.createDataFrame([], schema), f"file://{tmp_path}/none").count() == 0
    out = warc.archive_pages(spark.createDataFrame([(None, None, None)] * 2, schema), f"file://{tmp_path}/nulls").collect()
    assert [(r.page_id, r.urlkey, r.record_type, r.payload_bytes) for r in out] == [(None, "-", "response", 0)] * 2


def test_damaged_archive_is_noticed(tmp_path):
    path = tmp_path / "x.warc.gz"
    raw = warc.squeeze(warc.record(1, "http://a/", b"payload", None, warc.WarcOptions()), 6)
    path.write_bytes(raw[:-9])
    with pytest.raises(ValueError):
        list(warc.captures(str(path)))


def test_url_keys():
    assert warc.url_key("https://www.Example.com:443/A?b=C#x") == "com,example)/a?b=c"
    assert warc.url_key("http://m.example.org") == "org,example,m)/"
    assert warc.url_key(None) == warc.url_key("") == "-"


def test_loser_tree_merges_any_runs():
    rng = np.random.default_rng(2)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rng.integers(0, 20, rng.integers(0, 30)).tolist()) for _ in range(k)]
        merged = list(warc.loser_tree([iter([(x, x) for x in r]) for r in runs]))
        assert merged == sorted(x for r in runs for x in r)


def brute_shards(rows, limit):
    """Splits every bucket on one more bit until it fits; rows are (hash, bytes)."""
    out = {}

    def split(some, depth):
        if sum(b for _, b in some) <= limit or len(some) == 1:
            for h, b in some:
                out[h] = (format(h, "060b")[:depth], sum(x for _, x in some), len(some))
            return
        for bit in "01":
            part = [r for r in some if format(r[0], "060b")[depth] == bit]
            if part:
                split(part, depth + 1)

    split(rows, 0)
    return out


@pytest.mark.parametrize("limit", [1, 300, 4000, 10**9])
def test_shards_are_split_buckets(spark, limit):
    rng = np.random.default_rng(4)
    docs = [(i, "x" * int(rng.integers(0, 400))) for i in range(150)]
    out = sharding.assign_shards(spark.createDataFrame(docs, "doc_id long, text string"), limit).collect()
    hashes = {i: int(hashlib.md5(f"{i}:{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest()[:15], 16) for i, t in docs}
    want = brute_shards([(hashes[i], len(t)) for i, t in docs], limit)
    assert {r.doc_id: (r.shard, r.shard_bytes, r.shard_docs) for r in out} == {i: want[h] for i, h in hashes.items()}
    assert all(r.local_depth == len(r.shard) and r.oversized == (r.shard_bytes > limit) for r in out)


def test_equal_rows_split_too(spark, edge, nothing, tmp_path):
    docs = spark.createDataFrame([(None, "y" * 100)] * 40 + [(1, None), (2, "")], "doc_id long, text string")
    out = sharding.assign_shards(docs, 250).collect()
    sums = defaultdict(int)
    for r in out:
        sums[r.shard] += r.doc_bytes
    assert len(out) == 42 and max(sums.values()) <= 250 and all(sums[r.shard] == r.shard_bytes for r in out)
    assert sharding.assign_shards(nothing).count() == 0
    sharding.write_shards(edge, f"{tmp_path}/shards", limit=2000)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted(map(str, back.select(*edge.columns).collect())) == sorted(map(str, edge.collect()))
    assert "shard_" in back.columns


VECTORS = "vec_id long, embedding array<float>, score long, rank int"


def brute_top(rows, k, every):
    taken = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        taken.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    out = []
    for i, q in {(i, tuple(v)) for i, v in taken if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in taken if j != i)[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return sorted(out)


def search(spark, rows, k=5, every=5, head=3):
    vectors = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], VECTORS)
    return sorted(tuple(r) for r in topk.top_products(vectors, vectors.where(f"vec_id % {every} = 0"), k, head=head).collect())


def test_top_products_edge_cases(spark):
    importable(spark)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(60)]
    rows += [(60, [1.0] * 6), (61, [1.0] * 6), (61, [1.0] * 6), (62, [1.0] * 6), (63, None), (64, []), (65, [1.0, None] + [0.0] * 4), (65, [float("nan")] * 6)]
    rows += [(66, [float("inf")] * 6), (67, [2.0, -1.0]), (None, [9.0] * 6), (70, [0.0] * 6), (70, [0.0] * 6), (75, [1000.5] * 6)]
    assert search(spark, rows) == brute_top(rows, 5, 5)
    few = rows[:3]
    assert search(spark, few) == brute_top(few, 5, 5)
    assert search(spark, []) == [] and search(spark, [(5, [1.0])]) == []


def test_large_components_take_part(spark):
    for big in (2.0**20, 2.0**40):
        rows = [(0, [1.0, 0.5]), (1, [big, 1.0]), (2, [2.0, 2.0]), (3, [-big, 3.0])]
        docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
        got = [(r.query_id, r.vec_id, r.score) for r in topk.top_products(docs, docs.where("vec_id in (0, 2)")).orderBy("query_id", "rank").collect()]
        want = [(q, i, sum(a * b for a, b in zip(whole[q], whole[i]))) for q in (0, 2) for i in whole if i != q]
        assert got == sorted(want, key=lambda x: (x[0], -x[2], x[1]))


def test_pruning_keeps_every_result(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 100)
    monkeypatch.setattr(topk, "QUERY_ROWS", 16)
    rng = np.random.default_rng(7)
    rows = [(int(i), (rng.normal(size=12) * rng.lognormal(0, 1)).tolist()) for i in rng.permutation(900)]
    rows += [(i, rows[0][1]) for i in range(900, 1100)]  # one very common vector
    assert search(spark, rows, every=25, head=4) == brute_top(rows, 5, 25)
