"""Substring dedup of byte windows by column-wise suffix ordering.

A whole text is cut where the order is needed, not at fixed places: the *anchor* of
a window of ``WIDTH`` bytes is its ``GRAM`` bytes with the smallest hash, and a *run*
is the longest stretch of neighbouring windows with one anchor, a string of
``WIDTH`` to ``WIDTH + WIDTH - GRAM`` bytes. Equal windows have equal anchors, so

1. chunks exchange anchor hashes; runs whose anchor another document holds remain;
2. each chunk sends its distinct remaining runs, with the smallest doc_id that holds
   them, to the part of their anchor. A part builds the Burrows-Wheeler transform
   and common prefixes of its runs, one symbol of each string per round over
   sequential files (``bwt``): suffixes with a common prefix of ``WIDTH`` are equal
   windows. The answer is one bit per window: does a smaller doc_id hold it?

The strings are short, so the rounds are few and bounded whatever the length of the
documents, and a part holds a bounded share of the text. A window that begins d
bytes before its anchor ends ``WIDTH - GRAM`` - d bytes after it. Two runs with an equal
one agree around the anchor on all that windows of ``STEP`` neighbouring d have in common; a run
that agrees with no other of its anchor for any of these skips the rounds.

Defined cases: null or empty text has 0 bytes (SHA-256 of nothing); texts shorter
than ``WIDTH`` stay whole; null doc_id comes after all others; rows that share a
doc_id never remove bytes from each other; other columns are never read; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from docsift.llm import bwt
from docsift.llm import exchange as X
from docsift.llm import hashing as H

WIDTH = 50
GRAM = 20
PART_BYTES = 4 << 20
AT_ONCE = 20_000                              # runs ordered together
_SPAN = WIDTH - GRAM + 1                      # grams in a window, and windows in a run at most
_LONGEST = WIDTH + _SPAN - 1
STEP = 4
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every ``n`` neighbours."""
    width = 1
    while 2 * width <= n:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return np.minimum(values[:len(values) - (n - width)], values[n - width:]) if n > width else values


_NO_RUNS = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)


class Runs:
    """The runs of a chunk's texts, in order: document, start byte in the chunk, windows, anchor's place in the
    run, anchor hash."""

    def __init__(self, texts: list[bytes]):
        self.data, self.ends = H.joined(texts)
        self.starts = self.ends - np.array([len(t) for t in texts], np.int64)
        found, base, at = [], 0, 0
        for part in H.text_slices(texts):
            size = sum(map(len, part))
            found.append(self._slice(self.data[base:base + size], self.ends[at:at + len(part)] - base, base, at))
            base += size
            at += len(part)
        self.doc, self.start, self.windows, self.offset, self.key = (
            (np.concatenate(f) for f in zip(*found)) if found else _NO_RUNS)
        self.per_doc = np.bincount(self.doc, minlength=len(texts))

    @staticmethod
    def _slice(data: np.ndarray, ends: np.ndarray, base: int, first_doc: int):
        if len(data) < WIDTH:
            return _NO_RUNS
        h = H.windows(data.astype(np.uint64) + np.uint64(1), GRAM, base=H.BYTE_BASE)
        packed = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        anchor = (_least(packed, _SPAN) & np.uint64(0xFFFFFFFF)).astype(np.int64)     # the leftmost of equal ones
        doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        places = np.flatnonzero(doc[:len(anchor)] == doc[WIDTH - 1:WIDTH - 1 + len(anchor)])
        anchor = anchor[places]
        new = np.ones(len(places), bool)
        new[1:] = anchor[1:] != anchor[:-1]
        first = np.flatnonzero(new)
        return (doc[places[first]] + first_doc, places[first] + base, np.diff(first, append=len(places)),
                anchor[first] - places[first], h[anchor[first]])

    def strings(self, pick: np.ndarray) -> np.ndarray:
        """Length and bytes (zeros after the end) of the picked runs, a row each."""
        length = (self.windows[pick] + WIDTH - 1).astype(np.uint8)
        columns = np.arange(_LONGEST, dtype=np.int32)
        at = np.minimum(self.start[pick].astype(np.int32)[:, None] + columns, np.int32(max(0, len(self.data) - 1)))
        body = np.where(columns < length[:, None], self.data[at] if len(at) else np.uint8(0), np.uint8(0))
        return np.concatenate([length[:, None], body.astype(np.uint8)], axis=1)


_COLUMN = H.mixed(np.arange(1, _LONGEST + 2, dtype=np.uint64)) | np.uint64(1)


def _distinct(strings: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An index of each distinct row, in the order of ``key``, and each row's number among them.

    Rows are told apart by their anchor and a 64-bit hash of length and bytes.
    """
    h = np.zeros(len(strings), np.uint64)
    for column, factor in zip(strings.T, _COLUMN):
        h += (column.astype(np.uint64) + np.uint64(1)) * factor
    h = H.mixed(h)
    order = np.lexsort((h, key))
    new = np.ones(len(order), bool)
    new[1:] = (h[order[1:]] != h[order[:-1]]) | (key[order[1:]] != key[order[:-1]])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _anchors(runs: Runs):
    """Distinct anchor hashes, sorted; whether several documents of the chunk hold each; each run's number."""
    order, first, group = X.groups(runs.key)
    by = runs.doc[order]
    several = (np.minimum.reduceat(by, first) != np.maximum.reduceat(by, first)) if len(by) else np.zeros(0, bool)
    which = np.empty(len(order), np.int64)
    which[order] = group
    return runs.key[order][first], several, which


def _send_anchors(parts: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in X.tables(batches):
            keys, several, _ = _anchors(Runs(table["text"].to_pylist()))
            packed = (keys << np.uint64(1)).astype(np.uint32) | several
            yield X.block_batch(X.blocks(table["chunk"][0].as_py(), keys, [packed.astype(np.uint32)], parts))

    return send


def shared_anchors(packed: np.ndarray) -> np.ndarray:
    order, first, group = X.groups(packed >> np.uint32(1))
    out = np.zeros(len(packed), bool)
    if len(packed):
        flag = np.bitwise_or.reduceat(packed[order], first) & 1 > 0
        out[order] = (flag | (np.diff(first, append=len(packed)) > 1))[group]
    return out


def _entries(runs: Runs, near: np.ndarray, ids: np.ndarray):
    """The chunk's distinct remaining runs in anchor order: strings, anchors and their places, smallest ids; which
    runs remain, and the number of each."""
    pick = np.flatnonzero(near)
    strings, key = runs.strings(pick), runs.key[pick]
    index, number = _distinct(strings, key)
    least = np.full(len(index), X.LAST)
    np.minimum.at(least, number, ids[runs.doc[pick]])
    return strings[index], key[index], runs.offset[pick][index], least, pick, number


def _block(strings: np.ndarray, keys: np.ndarray, offsets: np.ndarray, least: np.ndarray) -> bytes:
    """Count, lengths, anchors' places, anchors, doc_ids low and high, then all bytes; compressed."""
    lengths = strings[:, 0]
    body = strings[:, 1:][np.arange(_LONGEST) < lengths[:, None]]
    return zstandard.compress(b"".join([
        np.uint32(len(strings)).tobytes(), lengths.tobytes(), offsets.astype(np.uint8).tobytes(),
        keys.astype(np.uint32).tobytes(), (least & 0xFFFFFFFF).astype(np.uint32).tobytes(),
        (least >> 32).astype(np.uint32).tobytes(), body.tobytes()]), 1)


def _unblock(block: bytes):
    block = zstandard.decompress(block)
    n = int(np.frombuffer(block, "<u4", 1)[0])
    lengths, offsets = (np.frombuffer(block, np.uint8, n, 4 + n * i) for i in range(2))
    key, low, high = (np.frombuffer(block, np.uint8, 4 * n, 4 + 2 * n + 4 * n * i).view("<u4") for i in range(3))
    strings = np.zeros((n, 1 + _LONGEST), np.uint8)
    strings[:, 0] = lengths
    strings[:, 1:][np.arange(_LONGEST) < lengths[:, None]] = np.frombuffer(block, np.uint8, offset=4 + 14 * n)
    return strings, key, offsets, low.astype(np.int64) | (high.astype(np.int64) << 32)


def _flank(strings: np.ndarray, at: np.ndarray, step: int) -> list[np.ndarray]:
    """Hashes of the first 0, 1, ... bytes of each row, from column ``at`` on in the direction of ``step``."""
    rows, out = np.arange(len(strings)), [np.zeros(len(strings), np.uint64)]
    for i in range(_SPAN - 1):
        column = np.clip(at + step * i, 0, _LONGEST)
        out.append(out[-1] + (strings[rows, column].astype(np.uint64) + np.uint64(1)) * _COLUMN[i])
    return out


def _agreeing(strings: np.ndarray, key: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Runs that agree with another run of their anchor on what windows that begin ``low`` to ``high`` bytes before it share."""
    out = np.zeros(len(strings), bool)
    offset, length = offset.astype(np.int64), strings[:, 0].astype(np.int64)
    before, after = _flank(strings, offset, -1), _flank(strings, offset + GRAM + 1, 1)
    for low in range(0, _SPAN, STEP):
        rest = max(0, _SPAN - low - STEP)
        rows = np.flatnonzero((offset >= low) & (offset + GRAM + rest <= length))
        h = key[rows].astype(np.uint64) * _COLUMN[-1] + H.mixed(before[low][rows]) + after[rest][rows]
        order = np.argsort(h := H.mixed(h))
        same = h[order[1:]] == h[order[:-1]]
        out[rows[order[1:][same]]] = True
        out[rows[order[:-1][same]]] = True
    return out


def _window_minima(strings: np.ndarray, key: np.ndarray, offset: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For distinct ``strings``: the smallest id that holds each of their windows (row: string, column: start)."""
    out = np.repeat(least[:, None], _SPAN, axis=1)
    several = np.flatnonzero(_agreeing(strings, key, offset))
    if len(several):
        string, start, equal = bwt.equal_substrings(strings[several, 1:], strings[several, 0], WIDTH)
        string = several[string]
        minima = np.full(int(equal.max()) + 1, X.LAST)
        np.minimum.at(minima, equal, least[string])
        out[string, start] = minima[equal]
    return out


def _held_before(strings: np.ndarray, key: np.ndarray, offset: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each run sent: does a smaller id hold the window that starts there? (row: run, column: start)

    Anchors are independent of each other, so they are worked off in groups of about ``AT_ONCE`` runs.
    """
    out = np.zeros((len(key), _SPAN), bool)
    order = np.argsort(key, kind="stable")
    cuts = np.flatnonzero(np.diff(key[order])) + 1
    start = 0
    while start < len(order):
        at = np.searchsorted(cuts, start + AT_ONCE)
        end = int(cuts[at]) if at < len(cuts) else len(order)
        rows = order[start:end]
        index, number = _distinct(strings[rows], key[rows])
        least = np.full(len(index), X.LAST)
        np.minimum.at(least, number, ids[rows])
        picked = rows[index]
        minima = _window_minima(strings[picked], key[picked], offset[picked], least)
        out[rows] = minima[number] < ids[rows][:, None]
        start = end
    return out


def _answer(table: pa.Table) -> pa.Table:
    held = [_unblock(b) for b in table["block"].to_pylist()]
    counts = [len(s) for s, *_ in held]
    strings, key, offset, ids = (np.concatenate(x) for x in zip(*held))
    del held
    before = _held_before(strings, key, offset, ids)
    real = np.arange(_SPAN) < (strings[:, 0].astype(np.int64) - WIDTH + 1)[:, None]
    bits, at = [], 0
    for n in counts:
        rows = slice(at, at + n)
        bits.append(np.packbits(before[rows][real[rows]]).tobytes())
        at += n
    return pa.table([table["chunk"], table["part"], pa.array(bits, pa.binary())], ["chunk", "part", "block"])


def _answered(strings: np.ndarray, keys: np.ndarray, replies: pa.Table, parts: int) -> np.ndarray:
    """Bits for every window of the chunk's distinct runs (row: run, column: start)."""
    real = np.arange(_SPAN) < (strings[:, 0].astype(np.int64) - WIDTH + 1)[:, None]
    out = np.zeros(real.shape, bool)
    bounds = X.part_bounds(keys, parts)
    got = dict(zip(replies["part"].to_pylist(), replies["block"].to_pylist()))
    for part, (a, b) in enumerate(zip(bounds, bounds[1:])):
        if a < b:
            n = int(real[a:b].sum())
            if len(got.get(part, b"")) != -(-n // 8):
                raise RuntimeError("the documents changed between two readings; write them to a table first")
            rows = np.zeros((b - a, _SPAN), bool)
            rows[real[a:b]] = np.unpackbits(np.frombuffer(got[part], np.uint8), count=n)
            out[a:b] = rows
    return out


def _near(runs: Runs, replies: pa.Table, parts: int) -> np.ndarray:
    """The chunk's runs whose anchor another document holds."""
    keys, _, which = _anchors(runs)
    return X.answered(keys, replies, parts)[which]


def _send_runs(parts: int):
    def send(docs: pa.Table, replies: pa.Table) -> pa.Table:
        rows = []
        if docs.num_rows:
            runs = Runs(docs["text"].to_pylist())
            strings, keys, offsets, least, *_ = _entries(runs, _near(runs, replies, parts), X.order_ids(docs["doc_id"]))
            bounds = X.part_bounds(keys, parts)
            rows = [(docs["chunk"][0].as_py(), part, _block(strings[a:b], keys[a:b], offsets[a:b], least[a:b]))
                    for part, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]
        return pa.Table.from_batches([X.block_batch(rows)])

    return send


def _remove(parts: int):
    def remove(docs: pa.Table, replies: pa.Table) -> pa.Table:
        out, texts = [], docs["text"].to_pylist()
        if texts:
            runs, ids = Runs(texts), X.order_ids(docs["doc_id"])
            near = _near(runs, X.of_round(replies, 0), parts)
            strings, keys, _, least, pick, number = _entries(runs, near, ids)
            hit = _answered(strings, keys, X.of_round(replies, 1), parts)[number]
            hit |= (least[number] < ids[runs.doc[pick]])[:, None]
            hit &= np.arange(_SPAN) < runs.windows[pick][:, None]
            run, offset = np.nonzero(hit)
            gone = X.covered(len(runs.data), runs.start[pick][run] + offset, WIDTH)
            for i, doc_id in enumerate(docs["doc_id"].to_pylist()):
                rows = slice(runs.starts[i], runs.ends[i])
                g = gone[rows]
                n = int(g.sum())
                spans = int(g[:1].sum()) + int((g[1:] & ~g[:-1]).sum())
                kept = runs.data[rows][~g].tobytes() if n else texts[i]
                out.append((doc_id, len(g), n, spans, hashlib.sha256(kept).hexdigest(), kept if n else None))
        columns = list(zip(*out)) or [()] * 6
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)],
                        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return remove


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes that stay, null where all stay)."""
    chunks, parts = X.chunked(docs), X.n_parts(docs, PART_BYTES)
    anchors = X.settled(X.answers(chunks.mapInArrow(_send_anchors(parts), X.BLOCK), ["<u4"], shared_anchors), "anchors")
    sent = chunks.groupBy("chunk").cogroup(anchors.groupBy("chunk")).applyInArrow(_send_runs(parts), X.BLOCK)
    windows = X.settled(sent.groupBy("part").applyInArrow(_answer, X.BLOCK), "windows")
    return chunks.groupBy("chunk").cogroup(X.rounds(anchors, windows).groupBy("chunk")).applyInArrow(
        _remove(parts), RESULT + ", kept binary")
