"""Cross-tokenizer alignment against a plain version; the perfect hash."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from corpus_fixtures import documents, ordered, stored
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docsift.llm import alignment as A
from docsift.llm.perfect_hash import PerfectHash

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["<|endoftext|> and <s> </s> <unk> <0x41>", "a ▁ b", "nul\x00l", "two  spaces", " lead", "trail ", "\n", "line\n\nline",
         "tab\tbed", ",start", ".5 x", "x²., y², z", "日本語の文章です。", "😀😃 emoji", "é composed", "don't can't I'll", "a_b __init__.py",
         "12345 678.90,12", "MiXeD CaSe,with.dots", " nbsp x", "\r\nwin\r\n", "a" * 500, "=" * 70 + " =", "é, ß. ñ", "a,\nb.\nc", "▁"]
ROWS = documents() + [(1000 + i, t) for i, t in enumerate(TEXTS)]


def bytes_of_entry(entry):
    """The usual table of byte-level vocabularies, written out."""
    plain = list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1)) + list(range(ord("®"), ord("ÿ") + 1))
    signs = {chr(b): b for b in plain}
    signs |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    return bytes(signs[c] for c in entry)


def expected(rows):
    a_tok, b_tok = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    a_tok.encode_special_tokens = True
    aligned = []
    for _, text in rows:
        found = []
        if text:
            a, b = a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)
            raw_a = [bytes_of_entry(a_tok.id_to_token(i)) for i in a]
            raw_b = [bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i)
                     else b_tok.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(raw_a) == b"".join(raw_b) == b" " + text.encode():
                i = j = end_a = end_b = 0
                ga, gb = [], []
                while i < len(a) or j < len(b):
                    if end_a <= end_b:
                        ga.append(a[i])
                        end_a += len(raw_a[i])
                        i += 1
                    else:
                        gb.append(b[j])
                        end_b += len(raw_b[j])
                        j += 1
                    if end_a == end_b and ga and gb:
                        found.append((ga, gb))
                        ga, gb = [], []
        aligned.append(found)
    held = Counter()
    for found in aligned:
        held.update({(x, y) for ga, gb in found for x in ga for y in gb})
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for (i, _), found in zip(rows, aligned):
        links = [(x, y) for ga, gb in found for x in ga for y in gb]
        written = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in found)
        out.append((i, sum(len(g) for g, _ in found), sum(len(g) for _, g in found), len(found), len(links),
                    sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
                    hashlib.sha256(written.encode()).hexdigest() if found else ""))
    return ordered(out)


@pytest.fixture(scope="module")
def want():
    return expected(ROWS)


@pytest.fixture(autouse=True)
def fresh_workers(spark):
    """Limits are set in this process; Python workers of an earlier test keep the tables of theirs."""
    spark.conf.set("spark.sql.pyspark.worker.reuse", "true")


def test_align(spark, tmp_path, want):
    docs = stored(spark, ROWS, tmp_path)
    assert ordered(A.align(docs, BYTE, PIECE).collect()) == want
    zeros = [r for r in want if r[1] == 0]
    assert 3 < len(zeros) < len(want) / 2 and all(r[2:] == (0, 0, 0, 0, 0, "") for r in zeros)
    assert A.align(docs.filter(F.lit(False)), BYTE, PIECE).count() == 0


def test_align_with_small_limits(spark, tmp_path, want, monkeypatch):
    """A tree of several levels, several blocks of counts, pairs let go early."""
    monkeypatch.setattr(A, "FAN_IN", 2)
    monkeypatch.setattr(A, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(A, "KEPT_PAIRS", 300)
    docs = stored(spark, ROWS, tmp_path, parts=9)
    assert ordered(A.align(docs, BYTE, PIECE).collect()) == want


def test_units_make_room(monkeypatch):
    """The table of units drops the old ones and keeps its numbers right."""
    monkeypatch.setattr(A, "MAX_UNITS", 40)
    monkeypatch.setattr(A, "JOINED", 7)
    pair = A.Pair(BYTE, PIECE)
    texts = [t for _, t in ROWS if t][:60]
    score = lambda pairs: (pairs % 7, pairs % 3 == 0)      # noqa: E731
    for keep_texts in (False, True):
        units, whole = A.Units(pair, score if keep_texts else None), A.Units(pair, score if keep_texts else None)
        for text in texts:
            if keep_texts:
                assert list(A._aligned(units, [text])) == list(A._aligned(whole, [text]))
            else:
                got = A._document_pairs(units, [text])
                ids = pair.whole(text)
                expected_pairs = set()
                if ids:
                    group_a, group_b = A.groups(*ids, pair)
                    for _, pairs, _ in A.links(ids[0], group_a, ids[1], group_b, pair.n_b):
                        expected_pairs |= set(pairs.tolist())
                assert set(got.tolist()) == expected_pairs


def test_long_groups_are_expanded_in_parts(monkeypatch):
    monkeypatch.setattr(A, "AT_ONCE", 5)
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 4, 40), rng.integers(0, 4, 60)
    of_a, of_b = np.sort(rng.integers(0, 3, 40)), np.sort(rng.integers(0, 3, 60))
    got = Counter()
    for g, p, t in A.links(a, of_a, b, of_b, 10):
        assert len(p) <= 10
        for x, y, z in zip(g.tolist(), p.tolist(), t.tolist()):
            got[x, y] += z
    assert got == Counter((int(g), int(x) * 10 + int(y)) for x, g in zip(a, of_a) for y, h in zip(b, of_b) if g == h)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 50_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 31, 2 * n))[:n].astype(np.uint64)
    found = PerfectHash.from_bytes(PerfectHash.of(rng.permutation(keys)).to_bytes())
    assert sorted(found.index(keys).tolist()) == list(range(len(keys)))
    assert len(found.to_bytes()) < 200 + n                                   # less than a byte a key
    other = found.index(np.setdiff1d(rng.integers(0, 1 << 31, 100).astype(np.uint64), keys))
    assert ((other >= -1) & (other < len(keys))).all()
