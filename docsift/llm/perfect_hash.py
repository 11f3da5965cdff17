"""Minimal perfect hashing of distinct integers, in numpy.

Level by level: every key left is hashed to one of twice as many bits; the bits that
exactly one key hits are set and their keys are done, the others go to the next level
with another seed. A key's index is the number of set bits before its own, over all
levels, so n keys get the numbers 0 to n - 1 at a few bits a key. A key that was not
hashed may get a number too, so who looks up compares the key stored there.
"""

from __future__ import annotations

import numpy as np

from docsift.llm.hashing import mixed

_STEP = 0x9E3779B97F4A7C15
LOAD = 2                     # bits for each key of a level
LEAST = 64                   # bits of a level at least


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(keys + np.uint64(_STEP * (level + 1) & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    def __init__(self, sizes: list[int], bits: list[np.ndarray]):
        self.sizes, self.bits = sizes, bits
        self.before, self.n = [], 0
        for packed in bits:
            counts = np.bitwise_count(packed).astype(np.int64)
            self.before.append((np.cumsum(counts) - counts + self.n).astype(np.int32 if self.n < 1 << 30 else np.int64))
            self.n += int(counts.sum())

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """For distinct ``keys`` (any order)."""
        left, sizes, bits = keys.astype(np.uint64), [], []
        while len(left):
            size = max(LEAST, LOAD * len(left))
            at = _places(left, len(sizes), size)
            hits = np.bincount(at, minlength=size)
            sizes.append(size)
            bits.append(np.packbits(hits == 1, bitorder="little"))
            left = left[hits[at] > 1]
        return cls(sizes, bits)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key; -1 where no level has it."""
        out = np.full(len(keys), -1, np.int64)
        open_, left = np.arange(len(keys)), keys.astype(np.uint64)
        for level, (size, packed, before) in enumerate(zip(self.sizes, self.bits, self.before)):
            at = _places(left, level, size)
            byte, bit = packed[at >> 3], (at & 7).astype(np.uint8)
            found = (byte >> bit) & 1 == 1
            below = byte[found] & ((np.uint8(1) << bit[found]) - np.uint8(1))
            out[open_[found]] = before[at[found] >> 3] + np.bitwise_count(below)
            open_, left = open_[~found], left[~found]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), *self.sizes], np.int64)
        return head.tobytes() + b"".join(b.tobytes() for b in self.bits)

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, n, 8).tolist()
        at, bits = 8 * (n + 1), []
        for size in sizes:
            bits.append(np.frombuffer(data, np.uint8, (size + 7) // 8, at))
            at += (size + 7) // 8
        return cls(sizes, bits)
