"""Benchmark decontamination: a broadcast set of hashed test n-grams.

A window is ``n`` consecutive words of an item (an item of fewer words, but not
none, is one window). Test words are numbered; each window is a row of numbers
with a 64-bit polynomial hash. A task numbers the words of a document (unknown
words cannot be part of a hit), hashes only the places where enough known words
stand together, looks the hashes up and verifies each hit word by word.

The benchmark reaches the tasks in blocks of at most ``BLOCK_BYTES`` of text, so
what is broadcast is bounded; with more than one block the spans found for a
document are merged by row.

Defined cases: null or empty text has no words (n_words 0, clean); null benchmark
texts and items without words have no windows; repeated item_ids count once;
windows of items without an id are hits, but no item is counted for them;
null doc_id and repeated rows are judged row by row; other columns are never
read; an empty documents table gives no rows, an empty benchmark no hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.rows import ROW, numbered, row_of, without_rows
from docsift.llm.words import alnum_words, small, utf8
from docsift.session import materialize

WINDOW = 13
BLOCK_BYTES = 16 << 20
SHARE = 20                     # contaminated: hits are at least 1 / SHARE of the words
_HITS = "row bigint, doc_id bigint, n_words bigint, spans array<bigint>, items array<string>"


class Grams:
    """Windows of one length: distinct rows of word numbers, their hashes and the items they come from."""

    def __init__(self, n: int, rows: list[tuple[int, ...]], items: list[int]):
        self.n = n
        windows, which = np.unique(np.array(rows, np.int64).reshape(-1, n), axis=0, return_inverse=True)
        self.base = 0x9E3779B97F4A7C15
        while True:
            powers = [pow(self.base, j, 1 << 64) for j in range(n)]
            self.powers = np.array(powers, np.uint64)
            hashes = self.hashed(windows)
            if len(np.unique(hashes)) == len(hashes):
                break
            self.base += 2
        order = np.argsort(hashes)
        self.hashes, self.windows = hashes[order], windows[order]
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.items: list[set[int]] = [set() for _ in order]
        for w, item in zip(place[which.ravel()].tolist(), items):
            self.items[w].add(item)

    def hashed(self, windows: np.ndarray) -> np.ndarray:
        return (windows.astype(np.uint64) * self.powers).sum(axis=1, dtype=np.uint64)

    def find(self, numbers: np.ndarray, together: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts in ``numbers`` of windows, and which windows; ``together[i]``: known words up to word i."""
        n = self.n
        starts = np.flatnonzero(together[n - 1:] >= n)
        if not len(starts):
            return starts, starts
        found = numbers[starts[:, None] + np.arange(n)]
        at = np.minimum(np.searchsorted(self.hashes, h := self.hashed(found)), len(self.hashes) - 1)
        hit = self.hashes[at] == h
        hit[hit] = (self.windows[at[hit]] == found[hit]).all(axis=1)
        return starts[hit], at[hit]


class TestSet:
    """The n-grams of a block of benchmark items."""

    def __init__(self, items: list[tuple[str | None, bytes]], n: int = WINDOW):
        self.items, self.n = items, n

    @cached_property
    def vocabulary(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(sorted({w for _, t in self.items for w in alnum_words(t)}), 1)}

    @cached_property
    def grams(self) -> list[Grams]:
        by_length: dict[int, tuple[list, list]] = {}
        for item, (_, text) in enumerate(self.items):
            numbers = [self.vocabulary[w] for w in alnum_words(text)]
            n = min(len(numbers), self.n)
            if n:
                rows, of = by_length.setdefault(n, ([], []))
                rows += [tuple(numbers[i:i + n]) for i in range(len(numbers) - n + 1)]
                of += [item] * (len(numbers) - n + 1)
        return [Grams(n, rows, of) for n, (rows, of) in sorted(by_length.items())]

    def scan(self, words: list[bytes]) -> tuple[list[int], list[str]]:
        """Hit spans as start, end, start, end, ... (words, ends exclusive, merged) and the ids of the items found."""
        known = self.vocabulary.get
        numbers = np.array([known(w, 0) for w in words], np.int64)
        place = np.arange(1, len(numbers) + 1)
        together = place - np.maximum.accumulate(np.where(numbers == 0, place, 0))
        spans, items = [], set()
        for grams in self.grams:
            if len(numbers) >= grams.n:
                starts, which = grams.find(numbers, together)
                spans += zip(starts.tolist(), (starts + grams.n).tolist())
                for w in set(which.tolist()):
                    items |= grams.items[w]
        return merged(spans), sorted({self.items[i][0] for i in items} - {None})


def merged(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _scanner(block):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = block.value
        for batch in small(batches):
            n_words, spans, items = [], [], []
            for text in utf8(batch["text"]):
                words = alnum_words(text)
                found = tests.scan(words) if words else ([], [])
                n_words.append(len(words))
                spans.append(found[0])
                items.append(found[1])
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["doc_id"], pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int64())),
                 pa.array(items, pa.list_(pa.string()))], ["row", "doc_id", "n_words", "spans", "items"])

    return scan


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """Items in blocks of bounded size; an item longer than that is a block of its own."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter(
        "text IS NOT NULL")
    for item_id, text in rows.toLocalIterator():
        raw = text.encode()
        if block and size + len(raw) > block_bytes:
            yield block
            block, size = [], 0
        block.append((item_id, raw))
        size += len(raw)
    yield block


def _merge(table: pa.Table) -> pa.Table:
    spans = [pair for s in table["spans"].to_pylist() for pair in zip(s[::2], s[1::2])]
    items = sorted({i for s in table["items"].to_pylist() for i in s})
    return pa.table([table["row"][:1], table["doc_id"][:1], table["n_words"][:1],
                     pa.array([merged(spans)], pa.list_(pa.int64())), pa.array([items], pa.list_(pa.string()))],
                    ["row", "doc_id", "n_words", "spans", "items"])


def hits(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """row, doc_id, n_words, spans, items for every row of ``docs(doc_id, text)``."""
    sc = docs.sparkSession.sparkContext
    tests = [sc.broadcast(TestSet(b, n)) for b in _blocks(benchmark, block_bytes)]
    if len(tests) > 1 and ROW not in docs.columns:
        docs = numbered(docs)                    # one reading for each block
    rows = docs.select(row_of(docs).alias("row"), F.col("doc_id").cast("bigint"), "text")
    passes = [rows.mapInArrow(_scanner(t), _HITS) for t in tests]
    if len(passes) == 1:
        return passes[0]
    found = materialize(passes[0], "block0")     # every row; of the others only rows with hits
    out = found
    for i, p in enumerate(passes[1:], 1):
        out = out.unionByName(materialize(p.filter("size(spans) > 0"), f"block{i}"))
    return out.groupBy("row").applyInArrow(_merge, _HITS)


_DIGEST = ("row bigint, doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
           "contaminated boolean")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_hit = [sum(s[1::2]) - sum(s[::2]) for s in batch["spans"].to_pylist()]
        items = batch["items"].to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch["row"], batch["doc_id"], batch["n_words"], pa.array(n_hit, pa.int64()),
             pa.array([len(i) for i in items], pa.int64()),
             pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items], pa.string()),
             pa.array([h > 0 and SHARE * h >= n for h, n in zip(n_hit, batch["n_words"].to_pylist())], pa.bool_())],
            [f.split()[0] for f in _DIGEST.split(", ")])


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row."""
    return hits(docs, benchmark).mapInArrow(_digest, _DIGEST).drop("row")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of the table ``docs`` that are not contaminated, with all their columns."""
    first, *more = islice(_blocks(benchmark, BLOCK_BYTES), 2)
    if not more:
        tests = docs.sparkSession.sparkContext.broadcast(TestSet(first))

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in small(batches):
                stays = []
                for text in utf8(batch["text"]):
                    words = alnum_words(text)
                    spans = tests.value.scan(words)[0] if words else []
                    n_hit = sum(spans[1::2]) - sum(spans[::2])
                    stays.append(not (n_hit > 0 and SHARE * n_hit >= len(words)))
                yield batch.filter(pa.array(stays, pa.bool_()))

        return docs.mapInArrow(keep, docs.schema)
    docs = numbered(docs)
    return without_rows(docs, hits(docs, benchmark).mapInArrow(_digest, _DIGEST).filter("contaminated"))
