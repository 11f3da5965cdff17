"""Substring dedup of word windows with fixed-block anchors.

A window of ``WINDOW`` = 2 * ``BLOCK`` - 1 words holds exactly one block of ``BLOCK``
words that starts at a multiple of ``BLOCK``. So the blocks at such places are the
index and every rolling window of ``BLOCK`` words probes it:

1. anchors: each chunk sends the hashes of its rolling block windows, marking those
   that stand at an indexed place; a hash is *shared* where an indexed block meets a
   probe from another document.
2. extension: around shared anchors the windows of full length are hashed (80 bits)
   and sent with the smallest doc_id that holds them; the answer is whether a
   document of a smaller doc_id outside the chunk holds them too. Neighbouring hits
   make up the maximal exact repeats, whose words go.

Both rounds use the packed exchange, so a passage that a third of all documents
share arrives once per chunk. The text moves twice, to meet the answers of each
round; what is stored between the rounds is answers only.

Defined cases: null or empty text has no words (n_words 0, SHA-256 of nothing);
texts of fewer than ``WINDOW`` words stay whole; null doc_id comes after all others;
rows that share a doc_id never remove words from each other; other columns are
never read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm import exchange as X
from docsift.llm import hashing as H

BLOCK_WORDS = 7
WINDOW = 2 * BLOCK_WORDS - 1
_ANCHOR = ["<u4"]                                   # 30 bits of the hash, shared within the chunk, indexed
_FULL = ["<u8", "<u2", "<u4", "<u4"]                # hash, 16 more bits, doc_id low and high
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


class Words:
    """The words of a chunk's texts as hashes, with the document of each."""

    def __init__(self, texts: list[bytes]):
        self.hashes, self.ends = H.words_of(texts)
        self.counts = np.diff(self.ends, prepend=0)
        self.starts = self.ends - self.counts
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int32), self.counts)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places whose ``n`` words lie in one document, and their hashes."""
        h = H.windows(self.hashes, n)
        places = np.flatnonzero(self.doc[:len(h)] == self.doc[n - 1:n - 1 + len(h)])
        return places, h[places]


def _anchors(words: Words):
    """Distinct block hashes of a chunk, sorted; flags; the places and which hash each has."""
    places, h = words.windows(BLOCK_WORDS)
    doc = words.doc[places]
    indexed = (places - words.starts[doc]) % BLOCK_WORDS == 0
    order, first, group = X.groups(h)
    keys = h[order][first]
    flags = np.zeros(len(keys), np.uint32)
    if len(keys):
        by = doc[order]
        flags |= (np.minimum.reduceat(by, first) != np.maximum.reduceat(by, first)).astype(np.uint32) << 1
        flags |= np.bitwise_or.reduceat(indexed[order].astype(np.uint32), first)
    which = np.empty(len(h), np.int64)
    which[order] = group
    return keys, flags, places, which


def _send_anchors(parts: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in X.tables(batches):
            keys, flags, _, _ = _anchors(Words(table["text"].to_pylist()))
            packed = (keys << np.uint64(2)).astype(np.uint32) | flags
            yield X.block_batch(X.blocks(table["chunk"][0].as_py(), keys, [packed], parts))

    return send


def shared_anchors(packed: np.ndarray) -> np.ndarray:
    """Whether two documents hold the key, one of them at an indexed place."""
    order, first, group = X.groups(packed >> np.uint32(2))
    out = np.zeros(len(packed), bool)
    if len(packed):
        flags = np.bitwise_or.reduceat(packed[order], first)
        several = np.diff(first, append=len(packed)) > 1
        out[order] = ((several | (flags & 2 > 0)) & (flags & 1 > 0))[group]
    return out


def held_before(key: np.ndarray, more: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether another block's smallest doc_id for the key is smaller."""
    order = np.lexsort((more, key))
    k, m = key[order], more[order]
    out = np.zeros(len(key), bool)
    if len(key):
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
        first = np.flatnonzero(new)
        doc = (low.astype(np.int64) | (high.astype(np.int64) << 32))[order]
        out[order] = np.minimum.reduceat(doc, first)[np.cumsum(new) - 1] < doc
    return out


def _full(words: Words, near: np.ndarray, ids: np.ndarray):
    """Distinct full windows near anchors: sorted keys, planes, places, which key each place has, smallest id."""
    places, h = words.windows(WINDOW)
    pick = near[places]
    places, h = places[pick], h[pick]
    more = (H.windows(words.hashes, WINDOW, base=0xD6E8FEB86659FD93)[places] >> np.uint64(48)).astype(np.uint16)
    order = np.lexsort((more, h))
    new = np.ones(len(h), bool)
    k, m = h[order], more[order]
    new[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
    first = np.flatnonzero(new)
    which = np.empty(len(h), np.int64)
    which[order] = np.cumsum(new) - 1
    doc = ids[words.doc[places]]
    least = np.minimum.reduceat(doc[order], first) if len(h) else doc
    planes = [k[first], m[first], (least & 0xFFFFFFFF).astype(np.uint32), (least >> 32).astype(np.uint32)]
    return k[first], planes, places, which, least


def _near(words: Words, replies: pa.Table, parts: int) -> np.ndarray:
    """The places whose full window lies in one document and holds a shared anchor."""
    keys, _, places, which = _anchors(words)
    hits = np.zeros(len(words.doc) + 1, np.int64)
    hits[places[X.answered(keys, replies, parts)[which]] + 1] = 1
    hits = np.cumsum(hits)                          # anchors before each place
    near = np.zeros(len(words.doc), bool)
    n = max(0, len(near) - WINDOW + 1)
    near[:n] = hits[WINDOW - BLOCK_WORDS + 1:][:n] > hits[:n]
    near[:n] &= words.doc[:n] == words.doc[WINDOW - 1:WINDOW - 1 + n]
    return near


def _send_windows(parts: int):
    def send(docs: pa.Table, replies: pa.Table) -> pa.Table:
        rows = []
        if docs.num_rows:
            words = Words(docs["text"].to_pylist())
            keys, planes, *_ = _full(words, _near(words, replies, parts), X.order_ids(docs["doc_id"]))
            rows = X.blocks(docs["chunk"][0].as_py(), keys, planes, parts)
        return pa.Table.from_batches([X.block_batch(rows)])

    return send


def _remove(parts: int):
    def remove(docs: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        texts, doc_ids = docs["text"].to_pylist(), docs["doc_id"].to_pylist()
        if texts:
            words, ids = Words(texts), X.order_ids(docs["doc_id"])
            near = _near(words, X.of_round(replies, 0), parts)
            keys, _, places, which, least = _full(words, near, ids)
            before = X.answered(keys, X.of_round(replies, 1), parts)
            hit = before[which] | (least[which] < ids[words.doc[places]])
            gone = X.covered(len(words.doc), places[hit], WINDOW)
            for i, text in enumerate(texts):
                g = gone[words.starts[i]:words.ends[i]]
                n, kept = int(g.sum()), text.split()
                if n:
                    kept = [w for w, x in zip(kept, g.tolist()) if not x]
                kept = b" ".join(kept)
                out.append((doc_ids[i], len(g), n, hashlib.sha256(kept).hexdigest(), kept if n else None))
        columns = list(zip(*out)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)],
                        ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return remove


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (text of the words that stay, null where all stay)."""
    chunks, parts = X.chunked(docs), X.n_parts(docs)
    anchors = X.settled(X.answers(chunks.mapInArrow(_send_anchors(parts), X.BLOCK), _ANCHOR, shared_anchors), "anchors")
    sent = chunks.groupBy("chunk").cogroup(anchors.groupBy("chunk")).applyInArrow(_send_windows(parts), X.BLOCK)
    windows = X.settled(X.answers(sent, _FULL, held_before), "windows")
    done = chunks.groupBy("chunk").cogroup(X.rounds(anchors, windows).groupBy("chunk")).applyInArrow(
        _remove(parts), RESULT + ", kept binary")
    return done.withColumn("kept", F.col("kept").cast("string"))
