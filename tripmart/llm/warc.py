"""WARC archives of pages, and a globally ordered capture index of them.

Writing: payloads are grouped by digest (a map-side combined maximum); of equal payloads the
page with the largest id is a ``response`` record, the others are ``revisit`` records that
refer to it. Every task writes its rows as archives of bounded size, one gzip member per
record, into the shared folder, and returns their names; only names of finished attempts are
in the (checkpointed) manifest, so lost executors leave at most unused files.

Index: every archive is read back and sorted by (URL key, timestamp, page id): a run. Range
bounds come from a bounded sample of the keys (by hash). Runs are cut at the
bounds, and each range is one task that merges its cuts with a loser tree; ranges are in
order and so are the captures in each. Bounds hold the page id, so captures of one URL
spread over ranges as well.

Defined cases: a null html is an empty payload; a null URL has the key ``-``; a null page id
ranks below all others and is carried as null (if a payload has only such pages, all are
responses); repeated rows with the largest id of their payload are all responses; a page of
any size is one record; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.session import shared_dir

from .common import as_binary, cut, slices, splittable, thinned

CAPTURE = "urlkey string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, archive string, record_offset long, record_length long"
NAMES = [c.split()[0] for c in CAPTURE.split(", ")]
TYPES = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in CAPTURE.split(", ")])
KEY = ["urlkey", "captured", "page_id"]
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


@dataclass(frozen=True)
class WarcOptions:
    #: payloads of fewer bytes are never revisits
    min_revisit_bytes: int = 0
    archive_bytes: int = 64 << 20
    gzip_level: int = 4
    #: a page is taken this many seconds after the epoch, plus its id (pages carry no time)
    epoch: int = 1_700_000_000
    #: keys sampled for the range bounds, also the most ranges that there can be
    sample_keys: int = 20_000
    captures_per_range: int = 20_000


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """Reversed host, then path and query, without scheme, port, ``www.`` and fragment; lower case."""
    if not url:
        return "-"
    try:
        parts = urlsplit(url if "//" in url else f"//{url}")
        host = parts.hostname or ""
    except ValueError:  # not a URL; its text still sorts
        return url.lower()
    host = re.sub(r"^www\d*\.", "", host)
    return f"{','.join(reversed(host.split('.')))}){(parts.path or '/').lower()}{'?' + parts.query.lower() if parts.query else ''}"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(f'{page_id}|{digest}'.encode()).digest()[:16])}>"


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None, how: WarcOptions) -> bytes:
    """One uncompressed record; ``first`` is the page that holds the payload of a revisit, else None."""
    digest = payload_digest(payload)
    taken = datetime.fromtimestamp(how.epoch, timezone.utc) + timedelta(seconds=(page_id or 0) % 10**9)
    block = HTTP % len(payload) + (payload if first is None else b"")
    head = [
        "WARC/1.0",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {taken:%Y-%m-%dT%H:%M:%SZ}",
        *([f"WARC-Target-URI: {quote(url, safe=';/?:@&=+$,#%[]!*()~')}"] if url else []),
        *([f"X-Page-Id: {page_id}"] if page_id is not None else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {record_id(first, digest)}", f"X-Refers-To-Page: {first}"] if first is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def squeeze(raw: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def members(chunks: Iterable[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """(offset, compressed length, content) of each gzip member of a stream; holds one member at a time."""
    offset, used, parts, unpacker = 0, 0, [], zlib.decompressobj(31)
    for chunk in chunks:
        while chunk:
            parts.append(unpacker.decompress(chunk))
            rest = unpacker.unused_data if unpacker.eof else b""
            used += len(chunk) - len(rest)
            if unpacker.eof:
                yield offset, used, b"".join(parts)
                offset, used, parts, unpacker = offset + used, 0, [], zlib.decompressobj(31)
            chunk = rest
    if used:
        raise ValueError("the archive ends within a record")


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def captures(path: str) -> Iterator[tuple]:
    """A row of CAPTURE for each record of an archive."""
    fs, name = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(name, compression=None) as stream:
        for offset, size, raw in members(iter(lambda: stream.read(1 << 20), b"")):
            fields, block = parse(raw)
            if fields["WARC-Type"] == "warcinfo":
                continue
            http, _, payload = block.partition(b"\r\n\r\n")
            response = fields["WARC-Type"] == "response"
            length = len(payload) if response else int(re.search(rb"Content-Length: (\d+)", http)[1])
            digest = payload_digest(payload) if response else fields["WARC-Payload-Digest"].removeprefix("sha1:")
            if digest != fields["WARC-Payload-Digest"].removeprefix("sha1:"):
                raise ValueError(f"{path} at {offset}: the payload does not match its digest")
            url = fields.get("WARC-Target-URI")
            page, first = (int(x) if x is not None else None for x in (fields.get("X-Page-Id"), fields.get("X-Refers-To-Page")))
            yield url_key(url), re.sub(r"\D", "", fields["WARC-Date"]), page, length, digest, fields["WARC-Type"], first, url, path, offset, size


def sort_key(row: tuple) -> tuple:
    """URL key, timestamp, page id (null first); then the place, so that equal captures have an order."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[8], row[9]


def loser_tree(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """Merges sorted iterators of (key, row); inner nodes hold the losers, so each step replays one path."""
    k = len(runs)
    heads = [next(r, None) for r in runs]
    losers = [-1] * k

    def beats(a: int, b: int) -> bool:
        """Run -1 (unset while the tree is built) beats all, an ended run loses to all."""
        if a == -1 or b == -1:
            return a == -1
        if heads[a] is None or heads[b] is None:
            return heads[b] is None and (heads[a] is not None or a < b)
        return (heads[a][0], a) < (heads[b][0], b)

    def replay(run: int) -> int:
        node, winner = (run + k) // 2, run
        while node:
            if beats(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2
        return winner

    top = -1
    for run in range(k):
        top = replay(run)
    while k and heads[top] is not None:
        yield heads[top][1]
        heads[top] = next(runs[top], None)
        top = replay(top)


def write_archives(pages: DataFrame, root: str, how: WarcOptions = WarcOptions(), page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Manifest (archive, records, size) of the archives that hold one record per row of ``pages``."""
    named = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    keyed = named.withColumn("payload", F.sha1(F.col("html").cast("binary")))
    firsts = named.select("page_id", F.sha1(F.col("html").cast("binary")).alias("payload")).groupBy("payload").agg(F.max("page_id").alias("first"))
    revisit = (F.octet_length("html") >= how.min_revisit_bytes) & (F.col("first") > F.coalesce("page_id", F.col("first") - 1))
    rows = keyed.join(splittable(firsts), "payload").select("page_id", "url", "html", F.when(revisit, F.col("first")).alias("first"))
    fs_root = root.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, base = pafs.FileSystem.from_uri(fs_root)
        fs.create_dir(base, recursive=True)
        made, sink = [], None
        for batch in slices(batches, "html"):
            for page, link, payload, first in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), as_binary(batch.column("html")), batch.column("first").to_pylist()):
                if sink is None:
                    name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{len(made):04d}.warc.gz"
                    sink = fs.open_output_stream(f"{base}/{name}", compression=None)
                    made.append([f"{fs_root}/{name}", 0, 0])
                    info = b"software: tripmart\r\nformat: WARC File Format 1.0\r\n"
                    sink.write(squeeze(b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: %s\r\nContent-Type: application/warc-fields\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (record_id(None, name).encode(), len(info), info), how.gzip_level))
                packed = squeeze(record(page, link, payload, first, how), how.gzip_level)
                sink.write(packed)
                made[-1][1] += 1
                made[-1][2] += len(packed)
                if made[-1][2] >= how.archive_bytes:
                    sink.close()
                    sink = None
        if sink is not None:
            sink.close()
        columns = list(zip(*made)) or [()] * 3
        yield pa.record_batch([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], names=["archive", "records", "size"])

    return cut(rows.mapInArrow(run, "archive string, records long, size long"))


def sorted_runs(manifest: DataFrame) -> DataFrame:
    """The captures of every archive, each archive's in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("archive").to_pylist():
                rows = sorted(captures(path), key=sort_key)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), TYPES.types)], schema=TYPES)

    return manifest.select("archive").mapInArrow(run, CAPTURE)


def merged_index(manifest: DataFrame, how: WarcOptions = WarcOptions()) -> DataFrame:
    """All captures with ``range_id`` and ``place``: in the order of these two they are globally sorted."""
    runs = cut(sorted_runs(manifest))
    n_captures = runs.count()
    n_ranges = max(1, -(-n_captures // how.captures_per_range))
    share = F.lit(min(1.0, how.sample_keys / max(1, n_captures)))
    sampled = runs.select(*KEY, F.xxhash64(*KEY).alias("h")).where(thinned("h", share)).distinct().collect()  # about sample_keys at most
    keys = sorted({sort_key((r["urlkey"], r["captured"], r["page_id"], *[""] * 5, "", -1)) for r in sampled})
    bounds = sorted({keys[i * len(keys) // n_ranges] for i in range(1, n_ranges)}) if keys else []

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct(list(TYPES)))
        for batch in batches:
            rows = batch.to_pylist()
            by_run: dict[str, list[dict]] = {}
            for r in rows:
                by_run.setdefault(r["archive"], []).append(r)
            out = []
            for run in by_run.values():
                order = [sort_key(tuple(r[c] for c in NAMES)) for r in run]
                cuts = [0, *(bisect_left(order, b) for b in bounds), len(run)]
                out += [(i, run[a:b]) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
            yield pa.record_batch([pa.array([i for i, _ in out], pa.int32()), pa.array([x for _, x in out], kind)], names=["range_id", "cut"])

    def merge(key: tuple, parts: pa.Table) -> pa.Table:
        def ordered(cut_rows: list[dict]) -> Iterator[tuple]:
            for r in cut_rows:
                row = tuple(r[c] for c in NAMES)
                yield sort_key(row), row

        rows = list(loser_tree([ordered(x) for x in parts.column("cut").to_pylist()]))
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), TYPES.types)]
        return pa.table([pa.array([key[0].as_py()] * len(rows), pa.int32()), pa.array(range(len(rows)), pa.int64()), *columns], names=["range_id", "place", *NAMES])

    cuts = runs.mapInArrow(split, f"range_id int, cut array<struct<{', '.join(c.replace(' ', ': ') for c in CAPTURE.split(', '))}>>")
    return cuts.repartition(n_ranges, "range_id").groupBy("range_id").applyInArrow(merge, f"range_id int, place long, {CAPTURE}")


def archive_pages(pages: DataFrame, root: str | None = None, how: WarcOptions = WarcOptions()) -> DataFrame:
    """Writes the archives (into a new folder of the shared directory if no root is given) and returns their merged index."""
    if root is None:
        root = f"{shared_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    return merged_index(write_archives(pages, root, how), how)
