"""Fill-in-middle with a learned rank index.

A text is a row of units (a run of ASCII letters, or one other code point). A cut
is given as a rank, "after k units", and has to become a byte offset. The boundary
offsets of a slice of texts are one rising sequence over their ranks; it is stored
as a piecewise-linear index:

* *segments*: a range of ranks is halved until the line through its ends is at most
  ``ERROR`` bytes away from every boundary in it. The search is done for all open
  ranges of a block at once, in numpy;
* *residuals*: what the line is off at each rank, one signed byte.

A cut is predicted by its segment's line and put right by its residual, so it is
exact. A long text is indexed in blocks of bounded size.

A document's cuts, form and order come from a SHA-256 of seed and doc_id, computed
in Spark, so a task that runs again gives the same rows. One narrow pass, no shuffle.

Defined cases: null text counts as empty; an empty text, one that holds a marker, and
one that the hash leaves out are ``plain`` (output is the text, ``prefix_chars`` and
``middle_chars`` are null); a null doc_id counts as the empty string in the hash;
repeated rows give repeated results; other columns are never read; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.hashing import text_slices
from docsift.llm.words import small, utf8

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
ERROR = 127                  # what a residual's byte holds
BLOCK = 1 << 20              # bytes indexed at a time
SCHEMA = ("doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary")

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_INSIDE = np.arange(256) & 0xC0 == 0x80        # a UTF-8 byte that goes on with a code point


@dataclass(frozen=True)
class Rates:
    """Of 100 documents, ``transformed`` are; of 100 transformed ones, ``spm`` have the suffix first."""

    seed: int = 1
    transformed: int = 90
    spm: int = 20


def boundaries(data: np.ndarray, firsts: np.ndarray) -> Iterator[np.ndarray]:
    """Offsets at which units start in ``data``, in blocks; a unit starts at each of ``firsts`` (rising)."""
    for start in range(0, len(data), BLOCK):
        block = data[start:start + BLOCK]
        letter = _LETTER[block]
        begins = ~_INSIDE[block]
        begins[1:] &= ~(letter[1:] & letter[:-1])
        if start and letter[0] and _LETTER[data[start - 1]]:
            begins[0] = False
        a, b = np.searchsorted(firsts, (start, start + len(block)))
        begins[firsts[a:b] - start] = True
        yield np.flatnonzero(begins) + start


class RankIndex:
    """rank -> offset of a rising sequence given in blocks (see the module's text)."""

    def __init__(self) -> None:
        self.n = 0
        self._first: list[np.ndarray] = []        # of each segment: its first rank, offset there, slope
        self._offset: list[np.ndarray] = []
        self._slope: list[np.ndarray] = []
        self._residual: list[np.ndarray] = []

    def add(self, offsets: np.ndarray) -> None:
        """Fits segments to the next offsets."""
        if not len(offsets):
            return
        lows, highs = np.array([0]), np.array([len(offsets)])       # open ranges [low, high)
        residual = np.zeros(len(offsets), np.int8)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(lows):
            sizes = highs - lows
            slopes = (offsets[highs - 1] - offsets[lows]) / np.maximum(sizes - 1, 1)
            starts = np.cumsum(sizes) - sizes
            step = np.arange(sizes.sum()) - np.repeat(starts, sizes)             # place within the range
            at = np.repeat(lows, sizes) + step
            off = offsets[at] - _predicted(np.repeat(offsets[lows], sizes), np.repeat(slopes, sizes), step)
            fits = np.maximum.reduceat(np.abs(off), starts) <= ERROR
            chosen = np.repeat(fits, sizes)
            residual[at[chosen]] = off[chosen]
            done.append((lows[fits], slopes[fits]))
            lows, highs = lows[~fits], highs[~fits]
            middle = (lows + highs) // 2
            lows, highs = np.concatenate([lows, middle]), np.concatenate([middle, highs])
        first, slope = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(first)
        self._first.append(first[order] + self.n)
        self._offset.append(offsets[first[order]])
        self._slope.append(slope[order])
        self._residual.append(residual)
        self.n += len(offsets)

    def close(self) -> RankIndex:
        """No more blocks come."""
        self.first, self.offset, self.slope, self.residual = (
            np.concatenate(x) if x else np.zeros(0, np.int64)
            for x in (self._first, self._offset, self._slope, self._residual))
        return self

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """Exact offsets of ``ranks``, each below ``n``."""
        segment = np.searchsorted(self.first, ranks, "right") - 1
        return (_predicted(self.offset[segment], self.slope[segment], ranks - self.first[segment])
                + self.residual[ranks])

    def ranks(self, offsets: np.ndarray) -> np.ndarray:
        """How many boundaries lie before each of ``offsets``: the segment's line turned round, then put right."""
        if not self.n:
            return np.zeros(len(offsets), np.int64)
        segment = np.maximum(np.searchsorted(self.offset, offsets, "right") - 1, 0)
        ends = np.append(self.first[1:], self.n)
        # units are a byte long at least, so a line that is ERROR bytes off is ERROR ranks off at most
        guess = (offsets - self.offset[segment]) / np.maximum(self.slope[segment], 1.0)
        near = self.first[segment] + np.rint(guess).astype(np.int64)
        low = np.maximum(near - ERROR - 1, self.first[segment])
        high = np.minimum(near + ERROR + 2, ends[segment])
        while (open_ := low < high).any():
            middle = (low + high) // 2
            before = np.zeros(len(offsets), bool)
            before[open_] = self.offsets(middle[open_]) < offsets[open_]
            low = np.where(open_ & before, middle + 1, low)
            high = np.where(open_ & ~before, middle, high)
        return low


def _predicted(offset, slope, step) -> np.ndarray:
    return offset + np.rint(slope * step).astype(np.int64)


def index_of(data: np.ndarray, firsts: np.ndarray) -> RankIndex:
    index = RankIndex()
    for offsets in boundaries(data, firsts):
        index.add(offsets)
    index.add(np.array([len(data)]))             # the last unit's end
    return index.close()


def _code_points(text: bytes) -> int:
    return len(text) - int(np.count_nonzero(_INSIDE[np.frombuffer(text, np.uint8)]))


def _transformed(texts: list[bytes], h1: np.ndarray, h2: np.ndarray, chosen: np.ndarray, spm: np.ndarray):
    """(n, form, prefix_chars, middle_chars, output) of each text."""
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    index = index_of(np.frombuffer(b"".join(texts), np.uint8), starts[starts < ends])
    first = index.ranks(starts)                                      # rank of each text's first boundary
    n = np.append(first[1:], index.n - 1) - first
    cuts = np.stack([h1 % (n + 1), h2 % (n + 1)])
    cuts = index.offsets(first + np.sort(cuts, axis=0)) - starts     # the end of the prefix, of the middle
    for i, text in enumerate(texts):
        if not (chosen[i] and text) or PREFIX in text or SUFFIX in text or MIDDLE in text:
            yield int(n[i]), PLAIN, None, None, text
            continue
        a, b = int(cuts[0, i]), int(cuts[1, i])
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if spm[i]:
            output = b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
        else:
            output = b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
        yield int(n[i]), SPM if spm[i] else PSM, _code_points(prefix), _code_points(middle), output


def fill_in_middle(docs: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output (string) for every row of ``docs(doc_id, text)``."""
    digest = F.sha2(F.concat(F.lit(f"{rates.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)

    def group(k: int) -> Column:
        return F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("bigint")

    rows = docs.select(F.col("doc_id").cast("bigint"), "text", digest.alias("digest")).select(
        "doc_id", "text", group(0).alias("h1"), group(1).alias("h2"),
        (group(2) % 100 < rates.transformed).alias("chosen"), (group(3) % 100 < rates.spm).alias("spm"))

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            given = [batch[c].to_numpy(zero_copy_only=False) for c in ("h1", "h2", "chosen", "spm")]
            at = 0
            for texts in text_slices(utf8(batch["text"]), BLOCK):
                rows = slice(at, at + len(texts))
                at += len(texts)
                n, form, prefix, middle, output = zip(*_transformed(texts, *(g[rows] for g in given)))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][rows], pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows.mapInArrow(transform, SCHEMA).withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` of this ``form`` was made from. Each marker stands in it once."""
    prefix, suffix, middle = (m.decode() for m in (PREFIX, SUFFIX, MIDDLE))
    head, last = F.substring_index(output, middle, 1), F.substring_index(output, middle, -1)
    second = F.when(form == SPM, F.substring_index(head, prefix, -1)).otherwise(F.substring_index(head, suffix, -1))
    first = F.when(form == SPM, F.substring_index(head, prefix, 1)).otherwise(F.substring_index(head, suffix, 1))
    first = F.substring(first, F.lit(len(PREFIX) + 1), F.length(first))
    return (F.when(form == PSM, F.concat(first, last, second))
            .when(form == SPM, F.concat(second, last, first)).otherwise(output))


def report(docs: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """``fill_in_middle`` with digests of its output and of the text restored from it."""
    return fill_in_middle(docs, rates).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
