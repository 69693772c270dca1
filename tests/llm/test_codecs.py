"""SentencePiece codec, token counts and packing against their libraries and brute force."""

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tripmart.llm import packing, sentencepiece_codec, token_counts
from tripmart.llm.common import table

from ..conftest import SF_SMALL

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.PieceCodec(PIECES, merges=True)


def test_ids_are_the_librarys(codec):
    rng = random.Random(1)
    texts = ["", " ", "\n", "  a  b \n\tc日𝔘 x  ", "▁x▁", "<s> </s>", "x" * 300, "a\0b", "é" * 50]
    texts += ["".join(rng.choice("aeinrst▁ \nhoé日.,1 ") for _ in range(rng.randint(1, 40))) for _ in range(500)]
    for text, ids, want in zip(texts, codec.encode(texts), sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(texts)):
        assert ids.tolist() == want == codec.encode_text(text)
        assert codec.decode(ids) == text.replace("▁", " ")


def test_unigram_mode_finds_the_best_score():
    codec = sentencepiece_codec.PieceCodec(PIECES, merges=False)

    def brute(text):
        best = -np.inf
        for cuts in itertools.product((0, 1), repeat=len(text) - 1):
            parts, begin = [], 0
            for i, c in enumerate((*cuts, 1), 1):
                if c:
                    parts.append(text[begin:i])
                    begin = i
            if all(p in codec.score for p in parts):
                best = max(best, sum(codec.score[p] for p in parts))
        return best

    for word in ("▁there", "▁stationed", "▁xqzab", "inging", "aaaaaaa"):
        assert sum(codec.weight[i] for i in codec.viterbi(word)) == pytest.approx(brute(word))


def test_encode_and_decode_documents(spark, edge, nothing):
    out = sentencepiece_codec.encode_documents(edge)
    assert out.where("round_trip").count() == edge.count() == out.count()
    back = {(r.doc_id, r.text) for r in sentencepiece_codec.decode_documents(out).collect()}
    assert back == {(r.doc_id, r.text or "") for r in edge.select("doc_id", "text").collect()}
    assert sentencepiece_codec.encode_documents(nothing).count() == 0
    lists = spark.createDataFrame([(1, None), (2, [None, 259]), (3, [])], "doc_id long, ids array<int>")
    assert [r.text for r in sentencepiece_codec.decode_documents(lists).orderBy("doc_id").collect()] == ["", " ", ""]


def test_spans_are_the_tokenizers(spark):
    how = token_counts.Counting()
    tokens = token_counts.tokenizer(how.ranks, how.pattern)
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for row in table(spark, SF_SMALL, "documents").limit(50).collect():
        begins, ends = tokens.spans(row.text)
        assert list(zip(begins.tolist(), ends.tolist())) == [tuple(o) for o in whole.encode(row.text, add_special_tokens=False).offsets]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_attribution_is_brute_force(rule):
    rng = np.random.default_rng(3)
    for _ in range(200):
        ends = np.cumsum(rng.integers(1, 6, rng.integers(1, 20)))
        begins = np.concatenate(([0], ends[:-1]))
        inner = np.sort(rng.integers(0, ends[-1] + 1, rng.integers(0, 6)))
        bounds = np.concatenate(([0], inner, [ends[-1]]))
        want = np.zeros(len(bounds) - 1)
        for b, e in zip(begins, ends):
            chars = [max(s for s in range(len(want)) if bounds[s] <= c < bounds[s + 1]) for c in range(b, e)]
            share = {s: chars.count(s) / len(chars) for s in chars}
            if rule == "share":
                for s, x in share.items():
                    want[s] += x
            else:
                want[{"first": chars[0], "last": chars[-1], "most": max(sorted(share), key=share.get)}[rule]] += 1
        counts, _ = token_counts.attribute(begins, ends, bounds, rule)
        assert counts == pytest.approx(want)


def test_sections_add_up(edge, nothing):
    by_row = defaultdict(list)
    for r in token_counts.count_tokens(edge.where("doc_id is not null").dropDuplicates(["doc_id"])).collect():
        by_row[r.doc_id].append(r)
    assert len(by_row) == 8
    for rows in by_row.values():
        assert sum(r.n_tokens for r in rows) == rows[0].doc_tokens
        rows.sort(key=lambda r: (("source", "lang", "text").index(r.field), r.section))
        assert [r.start for r in rows[1:]] == [r.stop for r in rows[:-1]]
    assert token_counts.count_tokens(edge).where("doc_id = 3 and field = 'lang'").count() == 2
    assert token_counts.count_tokens(nothing).count() == 0


def check_packing(docs, how):
    """Pieces make up every document's ids; sequences are gapless, and full or a power of two."""
    tokens = Tokenizer.from_file(WORDS)
    pieces = packing.pack_documents(docs, how).collect()
    sequences, of_doc = defaultdict(list), defaultdict(dict)
    for p in pieces:
        sequences[p.sequence_id].append(p)
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length
        of_doc[p.doc_id, p.doc_tokens].setdefault(p.start, []).append(p)
    for parts in sequences.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == np.cumsum([0, *(p.length for p in parts)])[:-1].tolist()
        total = sum(p.length for p in parts)
        assert total <= how.max_tokens and total & (total - 1) == 0
    by_id = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        by_id[r.doc_id].append([*tokens.encode(r.text or "", add_special_tokens=False).ids, how.close_id])
    for key, texts in by_id.items():
        found = [p for (k, _), starts in of_doc.items() if k == key for x in starts.values() for p in x]
        assert sum(p.length for p in found) == sum(map(len, texts))
        assert all(any(p.ids == ids[p.start : p.start + p.length] for ids in texts) for p in found)
        assert {x for ids in texts for x in range(len(ids))} == {x for p in found for x in range(p.start, p.start + p.length)}


def test_packing_edge_cases(edge, nothing):
    check_packing(edge, packing.Packing(max_tokens=256, pool_sequences=8))
    assert packing.pack_documents(nothing).count() == 0


def test_packing_of_documents(spark):
    docs = table(spark, SF_SMALL, "documents").limit(60)
    check_packing(docs, packing.Packing())


def test_costs_are_balanced():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 3000, 800).tolist()
    pieces = packing.pack(lengths)
    how = packing.Packing()
    cost = defaultdict(float)
    for _, _, n, sequence, _ in pieces:
        cost[sequence] += how.linear * n + how.quadratic * n * n
    full = [c for s, c in cost.items() if s < sum(lengths) // how.max_tokens]
    in_order = defaultdict(float)  # first fit in order of arrival, for comparison
    at = 0
    for n in lengths:
        while n:
            put = min(n, how.max_tokens - at % how.max_tokens)
            in_order[at // how.max_tokens] += how.linear * put + how.quadratic * put * put
            at, n = at + put, n - put
    assert np.std(full) < 0.6 * np.std(list(in_order.values()))
    assert len(pieces) < 1.5 * len(lengths)


def test_word_ids_are_the_tokenizers():
    import pyarrow as pa

    from tripmart.llm.word_ids import WordIds

    texts = ["", None, " \n ", "İstanbul ß ΑΣ ας ﬁ x\x1cy 日本語 é it's I'LL ²½ Ⱥⱥŉǰẞ ĸ'S", "<|endoftext|> a<|startoftext|>b<|ENDOFTEXT|> <|endoftext|é <|endoftext|>日", "x" * 3000, "é  y z"]
    tokens = Tokenizer.from_file(WORDS)
    ids, bounds = WordIds(WORDS).encode(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == tokens.encode(t or "", add_special_tokens=False).ids
