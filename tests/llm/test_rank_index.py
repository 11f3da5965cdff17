"""Fill-in-middle against a plain version; the rank index against the list of boundaries."""

import hashlib
import re

import numpy as np
import pytest
from corpus_fixtures import documents, ordered, sha, stored
from pyspark.sql import functions as F

from docsift.llm import fill_in_middle as M

ROWS = documents() + [(900, "a<P>b c d"), (901, "x <S> y"), (902, "<M>"), (903, "<P"), (904, "ab<"), (905, "S>12 ab\n\nč€😀 end"),
                      (906, "é" * 400 + " mixed WORDS 7 " * 300), (907, "letters" * 900)]


def expected(rows, seed=1):
    out = []
    for i, t in rows:
        t = t or ""
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
        n = len(units)
        h = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
            out.append((i, n, "plain", None, None, sha(t), sha(t)))
        elif h4 % 100 < 20:
            out.append((i, n, "spm", len(prefix), len(middle), sha(f"<S>{suffix}<P>{prefix}<M>{middle}"), sha(t)))
        else:
            out.append((i, n, "psm", len(prefix), len(middle), sha(f"<P>{prefix}<S>{suffix}<M>{middle}"), sha(t)))
    return ordered(out)


COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


@pytest.mark.parametrize("block", [1 << 20, 64])
def test_fill_in_middle(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(M, "BLOCK", block)              # texts longer than a block, many blocks of texts
    docs = stored(spark, ROWS, tmp_path)
    want = expected(ROWS)
    assert {r[2] for r in want} == {"plain", "psm", "spm"}
    assert ordered(M.report(docs).select(*COLUMNS).collect()) == want
    assert M.report(docs.filter(F.lit(False))).count() == 0


def test_blocks_do_not_show(monkeypatch):
    texts = [(t or "").encode() for _, t in ROWS]
    h1, h2 = (np.random.default_rng(k).integers(0, 1 << 32, len(texts)) for k in range(2))
    yes = np.ones(len(texts), bool)
    whole = list(M._transformed(texts, h1, h2, yes, yes))
    for block in (1, 7, 64):
        monkeypatch.setattr(M, "BLOCK", block)
        assert list(M._transformed(texts, h1, h2, yes, yes)) == whole


def test_outputs_and_rates(spark, tmp_path):
    docs = stored(spark, ROWS, tmp_path)
    out = M.fill_in_middle(docs, M.Rates(seed=7, transformed=100, spm=100))
    back = out.select("doc_id", "form", M.restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert ordered((r.doc_id, r.text) for r in back) == ordered((i, t or "") for i, t in ROWS)
    assert {r.form for r in back} == {"plain", "spm"}
    assert {r.form for r in M.fill_in_middle(docs, M.Rates(transformed=0)).collect()} == {"plain"}


@pytest.mark.parametrize("seed", range(20))
def test_rank_index_is_exact_within_its_error(seed):
    rng = np.random.default_rng(seed)
    steps = rng.integers(1, [2, 5, 50, 4000][seed % 4], 3000)
    steps[rng.integers(0, 3000, 5)] = 100_000                              # jumps that no line follows
    offsets = np.cumsum(steps)
    index = M.RankIndex()
    for part in np.split(offsets, np.sort(rng.integers(0, 3001, 4))):
        index.add(part)
    index.close()
    ranks = rng.permutation(3000)
    assert (index.offsets(ranks) == offsets[ranks]).all()
    assert (index.ranks(offsets[ranks]) == ranks).all()
    assert index.residual.dtype == np.int8 and len(index.residual) == 3000
    if seed % 4 < 2:
        assert len(index.first) < 150                                      # few segments, not one a boundary
