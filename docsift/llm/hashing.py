"""64-bit hashes of words and of runs of words or bytes, in numpy, over many texts at once.

All arithmetic is modulo 2**64. A run's hash is a difference of prefix sums times
an inverse power, so every window of any length costs a few array operations.
"""

from __future__ import annotations

import numpy as np

BYTE_BASE = 0x9E3779B97F4A7C15          # odd multipliers
WORD_BASE = 0xC2B2AE3D27D4EB4F
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
KEPT_POWERS = 1 << 20               # 16 MB for each base
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n; ``KEPT_POWERS`` of them are kept."""
    if base not in _powers:
        _powers[base] = _power_table(base, KEPT_POWERS)
    up, down = _powers[base] if n <= KEPT_POWERS else _power_table(base, n)
    return up[:n], down[:n]


def _power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    steps = [np.full(n, b, np.uint64) for b in (base, pow(base, -1, 1 << 64))]
    for s in steps:
        s[0] = 1
    return np.cumprod(steps[0], out=steps[0]), np.cumprod(steps[1], out=steps[1])


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all others."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _runs(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _power_tables(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


def windows(values: np.ndarray, n: int, base: int = WORD_BASE) -> np.ndarray:
    """Hash of every ``n`` consecutive values (numbers or word hashes)."""
    count = max(0, len(values) - n + 1)
    up, down = _power_tables(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64, copy=False) * up[:-1], out=sums[1:])
    return mixed((sums[n:] - sums[:count]) * down[:count]) if count else np.zeros(0, np.uint64)


def word_bounds(data: np.ndarray, ends: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data``, texts one after another; a text's end ends a word."""
    inside = ~space[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = ends[ends < len(data)]
    first[cuts] = inside[cuts]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    before = cuts[cuts > 0] - 1
    last[before] = inside[before]
    return starts, np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, ends: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the number of words up to each text's end."""
    starts, stops = word_bounds(data, ends, space)
    h = _runs(data.astype(np.uint64) + np.uint64(1), BYTE_BASE, starts, stops)
    return mixed(h + (stops - starts).astype(np.uint64)), np.searchsorted(starts, ends)


def text_slices(texts: list[bytes], size: int = 1 << 20):
    """Lists of texts of about ``size`` bytes (one text at least)."""
    part: list[bytes] = []
    n = 0
    for t in texts:
        part.append(t)
        n += len(t)
        if n >= size:
            yield part
            part, n = [], 0
    if part:
        yield part


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])


def words_of(texts: list[bytes], table: bytes | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and the number of words up to each text's end. ``table``: bytes.translate() first."""
    hashes, counts, n = [], [], 0
    for part in text_slices(texts):
        data, ends = joined([t.translate(table) for t in part] if table else part)
        h, c = word_hashes(data, ends)
        hashes.append(h)
        counts.append(c + n)
        n += len(h)
    if not counts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(counts)
