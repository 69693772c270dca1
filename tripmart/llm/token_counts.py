"""Token counts of fields and sections by offset-mapped attribution.

A document is its fields, joined by a separator; the text field is cut into sections at line
breaks. Sections tile the document (a separator or line break belongs to what it ends). The
document is encoded once, whole; the tokens' byte lengths give their character spans, and
these are interval-joined with the sections' spans (both in order: two binary searches a
token). A token that touches several sections is allocated by a rule:

- ``first``: the section of its first character;
- ``last``: the section of its last character;
- ``most``: the section with most of its characters, the earlier one of equals;
- ``share``: each section in proportion to its characters.

Counts of a document's sections add up to its tokens under every rule.

Defined cases: null fields are empty; an empty field or section has no tokens but a row; a
character that is split over tokens counts as touched by each; texts of any length are
encoded whole; every input row gives its rows, repeated ids included; an empty table gives
none; columns other than id and fields are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

RULES = ("first", "last", "most", "share")
COUNTS = "doc_id long, field string, section long, start long, stop long, n_tokens double, n_crossing long, doc_tokens long"


@dataclass(frozen=True)
class Counting:
    ranks: str = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern: str = public_tokenizers.PATTERN
    fields: tuple[str, ...] = ("source", "lang", "text")
    sectioned: str = "text"
    separator: str = " "
    rule: str = "most"


class OffsetTokenizer:
    """Byte-level tokenizer that tells each token's span in characters."""

    def __init__(self, ranks: str, pattern: str) -> None:
        with open(ranks, "rb") as f:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.sizes = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            self.sizes[rank] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character and the one after the last of every token."""
        ids = np.asarray(self.encoding.encode_ordinary(text), np.int64)
        ends = np.cumsum(self.sizes[ids])
        begins = ends - self.sizes[ids]
        if text.isascii():
            return begins, ends
        raw = np.frombuffer(text.encode(), np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1  # the character that each byte belongs to
        return char[begins], char[ends - 1] + 1


def sections(values: list[str | None], how: Counting) -> tuple[str, list[tuple[str, int]], np.ndarray]:
    """The whole document, (field, section) names, and their bounds in characters."""
    parts, names = [], []
    for k, (field, value) in enumerate(zip(how.fields, values)):
        closing = how.separator if k + 1 < len(how.fields) else ""
        lines = (value or "").split("\n") if field == how.sectioned else [value or ""]
        for n, line in enumerate(lines):
            parts.append(line + ("\n" if n + 1 < len(lines) else closing))
            names.append((field, n))
    return "".join(parts), names, np.cumsum([0, *map(len, parts)])


def attribute(begins: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) of every section; a crossing token counts as crossing wherever it touches."""
    n = len(bounds) - 1
    first = np.searchsorted(bounds, begins, "right") - 1
    last = np.searchsorted(bounds, ends - 1, "right") - 1
    crossing = np.flatnonzero(first != last)
    touched = np.zeros(n, np.int64)
    if rule == "last":
        counts = np.bincount(last, minlength=n).astype(float)
    else:
        counts = np.bincount(first, minlength=n).astype(float)
    for i in crossing:
        a, b = int(first[i]), int(last[i])
        overlap = np.minimum(bounds[a + 1 : b + 2], ends[i]) - np.maximum(bounds[a : b + 1], begins[i])
        touched[a : b + 1] += overlap > 0
        if rule == "most":
            counts[a] -= 1
            counts[a + int(np.argmax(overlap))] += 1
        elif rule == "share":
            counts[a] -= 1
            counts[a : b + 1] += overlap / overlap.sum()
    return counts, touched


_TOKENIZERS: dict[tuple[str, str], OffsetTokenizer] = {}


def tokenizer(ranks: str, pattern: str) -> OffsetTokenizer:
    """One per Python worker, kept between its tasks."""
    if (ranks, pattern) not in _TOKENIZERS:
        _TOKENIZERS[ranks, pattern] = OffsetTokenizer(ranks, pattern)
    return _TOKENIZERS[ranks, pattern]


def count_tokens(docs: DataFrame, how: Counting = Counting(), doc_id: str = "doc_id") -> DataFrame:
    """One row per section of every document; n_tokens is whole except under ``share``."""
    if how.rule not in RULES:
        raise ValueError(f"unknown rule {how.rule!r}; it is one of {RULES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokenizer(how.ranks, how.pattern)
        for batch in slices(batches, how.sectioned):
            columns: list[list] = [[] for _ in range(8)]
            fields = [batch.column(f).to_pylist() for f in how.fields]
            for key, *values in zip(batch.column("__id").to_pylist(), *fields):
                text, names, bounds = sections(values, how)
                begins, ends = tokens.spans(text)
                counts, touched = attribute(begins, ends, bounds, how.rule)
                n = len(names)
                for column, part in zip(columns, ([key] * n, [f for f, _ in names], [s for _, s in names], bounds[:-1].tolist(), bounds[1:].tolist(), counts.tolist(), touched.tolist(), [len(begins)] * n)):
                    column += part
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in COUNTS.split(", ")])

    named = docs.select(F.col(doc_id).cast("long").alias("__id"), *(F.col(f).cast("string").alias(f) for f in how.fields))
    return named.mapInArrow(run, COUNTS)
