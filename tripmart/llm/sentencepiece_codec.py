"""SentencePiece encoding and decoding with an Aho-Corasick automaton and one Viterbi pass.

The automaton holds all pieces. At each character it gives, over its output links, every
piece that ends there; each relaxes the best score of that position from the position where
the piece starts. Characters that no piece covers become byte pieces.

A unigram model allows any neighbours. A BPE model's ids are not the best sum of its scores,
so there a piece may only follow another if the model's merges, run over the two alone, leave
exactly these two; then at most one path reaches a position, and the ids are those of the merges.

Words are encoded many at a time: one numpy step per character position moves all words' automaton
states, follows the output links and relaxes the best scores. Words of rare characters and very
long ones are encoded one by one, by the same pass.

Texts are cut before each run of the space mark (no piece goes on after a mark that follows
another character; this is checked), and between any two characters that no piece holds side
by side: no piece and no merge crosses there. What is between cuts is encoded once per
distinct string and kept in bounded caches.

Defined cases: null and empty texts have no ids; the space mark itself in a text counts as a
space, as in the library; texts and words of any length are encoded whole; every input row
gives one row, repeated ids included; an empty table gives no rows; columns other than id
and text are not read.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gathered, slices

MARK = "▁"
CHUNKS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
CACHED_WORDS, CACHED_PARTS, CACHED_PAIRS, CACHED_LENGTH = 400_000, 250_000, 250_000, 48
#: words encoded together, and their greatest length
TOGETHER_WORDS, TOGETHER_LENGTH = 16_384, 64


class Automaton:
    """Aho-Corasick over strings: a trie, failure links, and links to the next shorter string that ends in a node."""

    def __init__(self, strings: dict[str, int]) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        self.depth: list[int] = [0]
        for text, value in strings.items():
            node = 0
            for c in text:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.ends.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = self.next[node][c]
            self.ends[node] = value
        self.fail = [0] * len(self.next)
        self.output = [0] * len(self.next)  # nearest node on the failure path that ends a string; 0: none
        queue = deque(self.next[0].values())
        while queue:
            node = queue.popleft()
            up = self.fail[node]
            self.output[node] = up if self.ends[up] >= 0 else self.output[up]
            for c, child in list(self.next[node].items()):
                if self.depth[child] > self.depth[node]:  # not a transition that step() kept
                    self.fail[child] = self.step(up, c)
                    queue.append(child)

    def step(self, node: int, c: str) -> int:
        """The node after one more character; found by failure links once, then kept in the node."""
        to = self.next[node].get(c)
        if to is None:
            to = self.next[node][c] = self.step(self.fail[node], c) if node else 0
        return to

    def outputs(self, node: int) -> list[int]:
        """Values of all strings that end in the node, the longest first: its own and those along its output links."""
        out = []
        at = node if self.ends[node] >= 0 else self.output[node]
        while at:
            out.append(self.ends[at])
            at = self.output[at]
        return out


class IntMap:
    """Numbers by keys that are whole numbers, looked up many at a time (open addressing)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        at, todo = self._slots(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[at[todo]] < 0
            self.keys[at[todo[free]]] = keys[todo[free]]  # of keys that want one slot, one gets it
            placed = self.keys[at[todo]] == keys[todo]
            self.values[at[todo[placed]]] = values[todo[placed]]
            todo = todo[~placed]
            at[todo] = (at[todo] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values of the keys, -1 for unknown ones."""
        at = self._slots(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.values[at], -1)
        todo = np.flatnonzero((there != keys) & (there >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            there = self.keys[at[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (there >= 0)]
        return out


class Merges:
    """Whether the merges of a BPE model leave two pieces side by side, for many pairs at a time.

    A piece's rank is the place of its merge in the order of scores (single characters: 0), its halves are
    what the last merge joined. Undoing the merges of both pieces from the latest on shows every
    moment at which the two pieces' inner ends were neighbours: the pair stays if no merge across came before the one undone.
    """

    def __init__(self, names: list[str], scores: np.ndarray, ids: dict[str, int]) -> None:
        self.n = len(names)
        long = np.array([len(x) > 1 for x in names])
        self.rank = np.where(long, 1 + np.unique(-scores, return_inverse=True)[1], 0)
        self.never = int(self.rank.max(initial=0)) + 2
        splits = [(ids.get(x[:k], -1), ids.get(x[k:], -1), i, len(x)) for i, x in enumerate(names) if x for k in range(1, len(x))]
        left, right, whole, size = np.array([x for x in splits if x[0] >= 0 and x[1] >= 0], np.int64).reshape(-1, 4).T
        self.whole = IntMap(left * self.n + right, whole)
        self.halves = np.full((2, self.n), -1, np.int64)
        self.real = np.array([len(x) == 1 for x in names])  # pieces that merges can make
        for length in range(2, int(size.max(initial=1)) + 1):  # shorter pieces' halves are known
            at = np.flatnonzero((size == length) & self.real[left] & self.real[right])
            at = at[self.stay(left[at], right[at], self.rank[whole[at]])]
            self.halves[0, whole[at]], self.halves[1, whole[at]] = left[at], right[at]
            self.real[whole[at]] = True

    def stay(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """For pairs of pieces that merges can make. With a limit, merges of that rank or later across the pair count as none."""
        rank, (first, second) = self.rank, self.halves
        left, right = left.copy(), right.copy()
        limit = np.full(len(left), self.never) if limit is None else limit.copy()
        out = np.ones(len(left), bool)
        todo = np.arange(len(left))
        while len(todo):
            a, b = left[todo], right[todo]
            whole = self.whole.get(a * self.n + b)
            across = (whole >= 0) & (rank[whole] < limit[todo])
            out[todo[across]] = False
            go = ~across & ((rank[a] > 0) | (rank[b] > 0))
            todo, a, b = todo[go], a[go], b[go]
            undo_left = rank[a] > rank[b]
            limit[todo] = np.where(undo_left, rank[a], rank[b] + 1)  # of equal merges the left one is first
            left[todo] = np.where(undo_left, second[a], a)
            right[todo] = np.where(undo_left, b, first[b])
        return out


class PieceCodec:
    """Encoder and decoder of one model file; ``merges`` says whether it is a BPE model."""

    def __init__(self, path: str, merges: bool) -> None:
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        p, n = self.processor, self.processor.get_piece_size()
        special = {i for i in range(n) if p.is_control(i) or p.is_unknown(i) or p.is_unused(i)}
        self.byte_ids = {int(p.id_to_piece(i)[3:5], 16): i for i in range(n) if p.is_byte(i)}
        self.ids = {p.id_to_piece(i): i for i in range(n) if i not in special and not p.is_byte(i)}
        if any(MARK in x.lstrip(MARK) for x in self.ids):
            raise ValueError("pieces that go on after a space mark are not supported")
        self.merges = merges
        self.score = {x: p.get_score(i) for x, i in self.ids.items()}
        self.names = dict(zip(self.ids.values(), self.ids))
        self.sizes = {i: len(x) for x, i in self.ids.items()}
        self.weight = {i: self.score[x] for x, i in self.ids.items()}
        self.unknown = min(self.score.values(), default=0.0) - 10.0
        self.automaton = Automaton(self.ids)
        self.ending: dict[int, list[tuple[int, float, int, str]]] = {}
        self.letters = {c for x in self.ids for c in x}
        self.together = {x[k : k + 2] for x in self.ids for k in range(len(x) - 1)}
        self.parts: dict[str, list[int]] = {}
        self.unk_id = p.unk_id()
        self.text_of = [b"" if i in special else bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace(MARK, " ").encode() for i in range(n)]
        self.words: dict[bytes, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        names = [self.names.get(i, "") for i in range(n)]
        self.size_of = np.array([len(x) for x in names])
        self.weight_of = np.array([self.score.get(x, 0.0) for x in names])
        self.joined = Merges(names, self.weight_of, self.ids) if merges else None
        self.code_of = np.zeros(0x110000, np.int64)  # of characters that are pieces themselves, from 1
        alone = sorted(x for x in self.ids if len(x) == 1)
        self.code_of[[ord(c) for c in alone]] = np.arange(1, len(alone) + 1)
        trie = self.automaton
        edges = [(node * (len(alone) + 1) + int(self.code_of[ord(c)]), to) for node, arcs in enumerate(trie.next) for c, to in arcs.items() if trie.depth[to] > trie.depth[node] and self.code_of[ord(c)]]
        self.edges = IntMap(*np.array(edges, np.int64).reshape(-1, 2).T)
        self.n_codes = len(alone) + 1
        self.fail, self.link, self.ends = (np.array(x, np.int64) for x in (trie.fail, trie.output, trie.ends))
        self.first_end = np.where(self.ends >= 0, np.arange(len(self.ends)), self.link)

    def merged(self, symbols: list[str], upto: int = 1) -> list[str]:
        """The model's merges over some symbols: the best-scored neighbours first, the leftmost of equal ones."""
        score = self.score
        while len(symbols) > upto:
            joins = [score.get(a + b, -np.inf) for a, b in zip(symbols, symbols[1:])]
            best = max(joins)
            if best == -np.inf:
                break
            at = joins.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def stay(self, left: str, right: str) -> bool:
        """Whether the merges leave these two side by side (left may be empty: right alone)."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs = {}
            if left:  # two that could still be merged do not stay
                known = left + right not in self.score and self.merged([*left, *right]) == [left, right]
            else:
                known = self.merged([*right]) == [right]
            self.pairs[key] = known
        return known

    def spell(self, char: str) -> list[int]:
        """Byte pieces of a character that no piece covers (the unknown id if the model has none)."""
        return [self.byte_ids[b] for b in char.encode()] if self.byte_ids else [self.unk_id]

    def viterbi(self, text: str) -> list[int]:
        """Ids of a string without cut points, in one pass over its characters."""
        goto, step, ending = self.automaton.next, self.automaton.step, self.ending
        merges, stay = self.merges, self.stay
        n = len(text)
        best = [0.0] + [-np.inf] * n
        piece = [-1] * (n + 1)
        last = [""] * (n + 1)
        node = 0
        for i, c in enumerate(text, 1):
            to = goto[node].get(c)
            node = step(node, c) if to is None else to
            found = ending.get(node)
            if found is None:
                found = ending[node] = [(self.sizes[p], self.weight[p], p, self.names[p]) for p in self.automaton.outputs(node)]
            for size, weight, p, name in found:
                reached = best[i - size] + weight
                if reached > best[i] and (not merges or stay(last[i - size], name)):
                    best[i], piece[i], last[i] = reached, p, name
                    if merges:
                        break  # at most one piece can end here
            if best[i] == -np.inf or not (merges or found and found[-1][0] == 1):
                reached = best[i - 1] + self.unknown  # the character alone, as bytes
                if reached > best[i]:
                    best[i], piece[i], last[i] = reached, -1, c
        out: list[int] = []
        i = n
        while i:
            p = piece[i]
            out += [p] if p >= 0 else reversed(self.spell(text[i - 1]))
            i -= self.sizes[p] if p >= 0 else 1
        return out[::-1]

    def _goto(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The automaton's states after one more character each."""
        out, todo = np.zeros(len(node), np.int64), np.arange(len(node))
        node = node.copy()
        while len(todo):
            to = self.edges.get(node[todo] * self.n_codes + code[todo])
            out[todo[to >= 0]] = to[to >= 0]
            todo = todo[(to < 0) & (node[todo] > 0)]
            node[todo] = self.fail[node[todo]]
        return out

    def _viterbi_of_all(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per word) of words in descending order of length; a column of codes is a word."""
        longest, n = codes.shape
        best = np.full((longest + 1, n), -np.inf)
        piece = np.full((longest + 1, n), -1, np.int64)
        best[0] = 0.0
        node = np.zeros(n, np.int64)
        for i in range(1, longest + 1):
            going = int(np.searchsorted(-sizes, -i, "right"))
            node = self._goto(node[:going], codes[i - 1, :going])
            at = self.first_end[node]
            todo = np.flatnonzero(at)
            while len(todo):  # all pieces that end here, along the output links
                p = self.ends[at[todo]]
                begin = i - self.size_of[p]
                reached = best[begin, todo] + self.weight_of[p]
                better = reached > best[i, todo]
                if self.joined is not None:
                    before = piece[begin, todo]
                    better &= self.joined.real[p]
                    inner = np.flatnonzero(better & (begin > 0))
                    better[inner] = self.joined.stay(before[inner], p[inner])
                to = todo[better]
                best[i, to], piece[i, to] = reached[better], p[better]
                at[todo] = self.link[at[todo]]
                todo = todo[at[todo] > 0]
        place, todo, back = sizes.copy(), np.arange(n), []
        while len(todo):
            p = piece[place[todo], todo]
            back.append((todo, p))
            place[todo] -= self.size_of[p]
            todo = todo[place[todo] > 0]
        counts = np.zeros(n, np.int64)
        for todo, _ in back:
            counts[todo] += 1
        ends = np.cumsum(counts)
        ids = np.zeros(int(ends[-1]) if n else 0, "<u4")
        for k, (todo, p) in enumerate(back, 1):
            ids[ends[todo] - k] = p
        return ids, counts

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of strings without cut points as little-endian unsigned 32-bit integers."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        codes = self.code_of[flat]
        ends = np.cumsum(sizes)
        plain = (sizes > 0) & (sizes <= TOGETHER_LENGTH)
        known = np.concatenate(([0], np.cumsum(codes > 0)))
        plain &= known[ends] - known[ends - sizes] == sizes
        out = [b""] * len(words)
        strange = {chr(c) for c in np.unique(flat[codes == 0]).tolist()} - self.letters  # no piece crosses these
        between = re.compile(f"([{''.join(map(re.escape, sorted(strange)))}])") if strange else None
        cut: list[tuple[int, list[str]]] = []
        for i in np.flatnonzero(~plain).tolist():
            parts = [p for p in between.split(words[i]) if p] if between else [words[i]]
            if len(parts) > 1:
                cut.append((i, parts))
            else:
                out[i] = np.array(self.chunk(words[i]), "<u4").tobytes()
        if cut:
            pieces = list({p for _, parts in cut for p in parts if p not in strange})
            known_parts = dict(zip(pieces, self.encode_words(pieces))) | {c: np.array(self.spell(c), "<u4").tobytes() for c in strange}
            for i, parts in cut:
                out[i] = b"".join(map(known_parts.__getitem__, parts))
        order = np.flatnonzero(plain)
        order = order[np.argsort(-sizes[order], kind="stable")]
        for k in range(0, len(order), TOGETHER_WORDS):
            some = order[k : k + TOGETHER_WORDS]
            n = sizes[some]
            within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            table = np.zeros((int(n[0]), len(some)), np.int64)
            table[within, np.repeat(np.arange(len(some)), n)] = codes[within + np.repeat(ends[some] - n, n)]
            ids, counts = self._viterbi_of_all(table, n)
            raw, bounds = ids.tobytes(), np.cumsum(np.concatenate(([0], 4 * counts))).tolist()
            for i, a, b in zip(some.tolist(), bounds, bounds[1:]):
                out[i] = raw[a:b]
        return out

    def chunk(self, text: str) -> list[int]:
        """Ids of a string, cut where no piece holds both neighbours."""
        together, parts = self.together, self.parts
        out: list[int] = []
        begin = 0
        for i in range(1, len(text) + 1):
            if i < len(text) and text[i - 1 : i + 1] in together:
                continue
            part = text[begin:i]
            begin = i
            ids = parts.get(part)
            if ids is None:
                ids = self.viterbi(part) if part[0] in self.letters else self.spell(part)
                if len(part) <= CACHED_LENGTH:
                    if len(parts) >= CACHED_PARTS:
                        parts.clear()
                    parts[part] = ids
            out += ids
        return out

    def encode_text(self, text: str) -> list[int]:
        return [i for chunk in CHUNKS.findall(self.processor.normalize(text)) for i in self.chunk(chunk)]

    def lookup(self, words: list[bytes]) -> list[bytes]:
        known = self.words
        if len(known) > CACHED_WORDS:  # the newer half stays
            known = self.words = dict(islice(known.items(), len(known) // 2, None))
        new = [w for w in words if w not in known]
        known.update(zip(new, self.encode_words([MARK + w.decode() for w in new])))
        found = [known[w] for w in words]
        for w in new:
            if len(w) > CACHED_LENGTH:
                del known[w]
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Texts with single spaces go through the table of distinct words, others chunk by chunk."""
        plain = [self.processor.normalize(t) if t else "" for t in texts]
        regular = [t[:1] == MARK and MARK * 2 not in t and t[-1] != MARK for t in plain]
        words = pc.split_pattern(pa.array([t[1:] if r else None for t, r in zip(plain, regular)], pa.string()).drop_null(), MARK)
        ids, bounds = gathered(words, self.lookup)
        rows = iter(np.split(ids, bounds[1:-1]) if len(words) else [])
        return [next(rows) if r else np.array([i for x in CHUNKS.findall(t) for i in self.chunk(x)], "<u4") for t, r in zip(plain, regular)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids; the space that encoding puts first is dropped, bytes that are no UTF-8 are replaced."""
        raw = b"".join(map(self.text_of.__getitem__, ids.tolist()))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


_CODECS: dict[tuple[str, bool], PieceCodec] = {}


def codec(path: str, merges: bool) -> PieceCodec:
    """One per Python worker, kept between its tasks."""
    if (path, merges) not in _CODECS:
        _CODECS[path, merges] = PieceCodec(path, merges)
    return _CODECS[path, merges]


def encode_documents(docs: DataFrame, path: str = public_tokenizers.path("piece_bpe_32k.model"), merges: bool = True, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip): round_trip says whether decoding gives the text back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = codec(path, merges)
        for batch in slices(batches, "text"):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            ids = model.encode(texts)
            sizes = np.array([len(x) for x in ids], np.int64)
            flat = np.concatenate(ids).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(flat))
            same = [model.decode(i) == t for i, t in zip(ids, texts)]
            yield pa.record_batch([batch.column("doc_id"), pa.array(sizes), lists, pa.array(same)], names=["doc_id", "n_tokens", "ids", "round_trip"])

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return named.mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decode_documents(encoded: DataFrame, path: str = public_tokenizers.path("piece_bpe_32k.model"), merges: bool = True, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, text) of id lists; null lists and null ids decode to nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = codec(path, merges)
        for batch in batches:
            texts = [model.decode(np.array([i for i in x or [] if i is not None], np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    named = encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))
    return named.mapInArrow(run, "doc_id long, text string")
