"""Token ids of whole documents with a word-level BPE tokenizer, one BPE run per distinct word part.

The tokenizer drops white space and never merges across it, so a document's ids are the ids
of its words. Arrow splits a slice of documents into words and numbers the distinct ones;
ids are looked up (or made) per distinct word and gathered for all words at once.

New words of printable ASCII and Latin letters are cut into the tokenizer's pre-tokens here, all
in one text, and only new pre-tokens go through its BPE model. All other words, and those that may
hold one of its added tokens, go through the whole tokenizer.
"""

from __future__ import annotations

import re
import unicodedata
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from .common import gathered

PLAIN = r"[!-~¡-ɏ]+"
CACHED_WORDS, CACHED_PARTS, CACHED_LENGTH = 500_000, 400_000, 48


def _pre_tokens() -> re.Pattern:
    """The tokenizer file's split pattern (a fixed value) for words of plain characters in lower case, and line ends."""
    chars = sorted({c for code in (*range(0x21, 0x7F), *range(0xA1, 0x250)) for c in chr(code).lower()})
    letters, numbers = ("".join(map(re.escape, (c for c in chars if unicodedata.category(c)[0] == kind))) for kind in "LN")
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+|\n")


PRE_TOKENS = _pre_tokens()
#: stands for the end of a word among ids
END = b"\xff" * 4


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for letters from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordIds:
    """Encodes string columns; caches are bounded and change no result."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        added = "|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        self.plain = re.compile(f"(?!.*(?:{added})){PLAIN}" if added else PLAIN, re.DOTALL).fullmatch
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {"\n": END}

    def _learn(self, part: str) -> bytes:
        spelt = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(spelt)], "<u4").tobytes()

    def _plain(self, words: list[str]) -> list[bytes]:
        """Ids of words of plain characters."""
        parts = PRE_TOKENS.findall("\n".join([*words, ""]).lower())
        if len(self.parts) > CACHED_PARTS:  # the newer half stays
            self.parts = {"\n": END} | dict(islice(self.parts.items(), len(self.parts) // 2, None))
        known = self.parts
        new = set(parts).difference(known)
        known.update(zip(new, map(self._learn, new)))
        raw = b"".join([known[p] for p in parts])
        for part in new:
            if len(part) > CACHED_LENGTH:
                del known[part]
        ends = (4 * np.flatnonzero(np.frombuffer(raw, "<u4") == 0xFFFFFFFF)).tolist()
        return [raw[a:b] for a, b in zip([0, *(e + 4 for e in ends[:-1])], ends)]

    def lookup(self, words: list[bytes]) -> list[bytes]:
        """The ids of words as little-endian unsigned 32-bit integers."""
        if len(self.words) > CACHED_WORDS:
            self.words = dict(islice(self.words.items(), len(self.words) // 2, None))
        known = self.words
        new = [w for w in words if w not in known]
        plain, texts, others, rest = [], [], [], []
        for w, t in zip(new, [w.decode() for w in new]):
            if self.plain(t):
                plain.append(w)
                texts.append(t)
            else:
                others.append(w)
                rest.append(t)
        known.update(zip(plain, self._plain(texts)))
        known.update(zip(others, (np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))))
        found = [known[w] for w in words]
        for w in new:
            if len(w) > CACHED_LENGTH:
                del known[w]
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, bounds of each row's ids); null is an empty text."""
        return gathered(pc.ascii_split_whitespace(pc.fill_null(texts, "")), self.lookup)
