"""Column-wise Burrows-Wheeler transform and common prefixes of many short strings.

Round r inserts, for every string at once, the symbol that stands before its last
r - 1 symbols. All suffixes so far are kept in sorted order as two files: the
symbol before each suffix (the transform) and the common prefix of each suffix
with its predecessor. A round reads both files, finds every new suffix's place
from the symbols before it (equal symbols keep their order), takes its common
prefixes as one more than the least between the two places it came from, and
writes both files anew, front to back. No suffix is ever stored or compared.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

SPANS = 1 << 20     # common prefixes looked through at a time
END = 0            # the symbol before a whole string; bytes are shifted up by one (0xFF is never part of UTF-8)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after another."""
    ends = np.cumsum(lengths)
    out = np.ones(int(ends[-1]) if len(ends) else 0, np.int64)
    if len(out):
        out[0] = starts[0]
        out[ends[:-1]] = starts[1:] - starts[:-1] - lengths[:-1] + 1
        np.cumsum(out, out=out)
    return out


def least_between(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of ``values[a:b]`` for each pair, in bounded memory."""
    out = np.empty(len(a), values.dtype)
    ends = np.cumsum(b - a, dtype=np.int64)
    at = 0
    while at < len(a):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SPANS)))
        length = (b - a)[at:to].astype(np.int64)
        first = np.cumsum(length) - length
        out[at:to] = np.minimum.reduceat(values[ragged(a[at:to].astype(np.int64), length)], first)
        at = to
    return out


class Collection:
    """``symbols``: strings in rows, left-aligned, of ``lengths`` bytes (at least 1, at most 254)."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, folder: str):
        self.symbols, self.lengths, self.folder = symbols, lengths.astype(np.int64), folder
        self.n, self.round = len(symbols), -1
        at = np.arange(self.n)
        self._write(symbols[at, self.lengths - 1].astype(np.uint8) + np.uint8(1), np.zeros(self.n, np.uint8))
        self.owner = at.astype(np.int32)            # strings with a symbol still to insert, by place
        self.place = at.copy()                      # where their last inserted suffix stands

    def _file(self, name: str) -> str:
        return os.path.join(self.folder, f"{name}{self.round}")

    def _write(self, bwt: np.ndarray, lcp: np.ndarray) -> None:
        """The files of the next round; those of the last go."""
        last = [self._file("bwt"), self._file("lcp")] if self.round >= 0 else []
        self.round += 1
        bwt.tofile(self._file("bwt"))
        lcp.tofile(self._file("lcp"))
        for path in last:
            os.unlink(path)

    def read(self) -> tuple[np.ndarray, np.ndarray]:
        return np.fromfile(self._file("bwt"), np.uint8), np.fromfile(self._file("lcp"), np.uint8)

    def insert(self, r: int) -> None:
        """Round ``r``: the suffixes of length r of all strings that long."""
        bwt, lcp = self.read()
        # suffix i (after the empty ones) = symbol at came[i] + suffix came[i]
        came = np.argsort(bwt, kind="stable")[np.count_nonzero(bwt == END):].astype(np.int32)
        string = np.full(len(bwt), -1, np.int32)
        string[self.place] = self.owner
        string = string[came]
        new = string >= 0
        owner = string[new]
        rest_bwt, rest_lcp = np.empty(len(came), np.uint8), np.empty(len(came), np.uint8)
        rest_bwt[~new], rest_lcp[~new] = bwt[self.n:], lcp[self.n:]
        left = self.lengths[owner] - r              # symbols still before the new suffixes
        before = self.symbols[owner, np.maximum(left - 1, 0)] + np.uint8(1)
        rest_bwt[new] = np.where(left > 0, before, END)
        # the new suffixes and those right after one get their common prefix with the suffix before
        check = new.copy()
        check[1:] |= new[:-1]
        i = np.flatnonzero(check)
        same = (i > 0) & (bwt[came[i]] == bwt[came[np.maximum(i - 1, 0)]])
        rest_lcp[i[~same]] = 0
        i = i[same]
        if len(i):
            rest_lcp[i] = least_between(lcp, came[i - 1] + 1, came[i] + 1) + np.uint8(1)
        self._write(np.concatenate([bwt[:self.n], rest_bwt]), np.concatenate([lcp[:self.n], rest_lcp]))
        place = self.n + np.flatnonzero(new)
        more = left > 0
        self.owner, self.place = owner[more], place[more]

    def build(self) -> None:
        r = 0
        while len(self.owner):
            r += 1
            self.insert(r)

    def classes(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every substring of ``width`` bytes: its string, its start, and a number equal for equal substrings."""
        bwt, lcp = self.read()
        came = np.argsort(bwt, kind="stable")[np.count_nonzero(bwt == END):].astype(np.int32)
        longer = np.zeros(len(bwt), np.int32)       # place of the suffix one symbol longer
        longer[came] = self.n + np.arange(len(came))
        number = np.cumsum(lcp < width, dtype=np.int32)
        strings, starts, numbers = [], [], []
        alive, place = np.arange(self.n), np.arange(self.n)
        for r in range(1, int(self.lengths.max(initial=0)) + 1):
            alive, place = alive[self.lengths[alive] >= r], place[self.lengths[alive] >= r]
            place = longer[place]
            if r >= width:
                strings.append(alive)
                starts.append(self.lengths[alive] - r)
                numbers.append(number[place])
        if not strings:
            return (np.zeros(0, np.int64),) * 3
        return np.concatenate(strings), np.concatenate(starts), np.concatenate(numbers)


def equal_substrings(symbols: np.ndarray, lengths: np.ndarray, width: int):
    """``Collection.classes`` of the strings; the working files go when it is done."""
    with tempfile.TemporaryDirectory(prefix="bwt-") as folder:
        collection = Collection(symbols, lengths, folder)
        collection.build()
        return collection.classes(width)
