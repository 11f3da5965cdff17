"""Cross-tokenizer alignment: which tokens of A and B stand for the same stretch of text, counted over the corpus.

A is a byte-level BPE (``tokenizers``, over a space and the text), B a ``sentencepiece``
model, which adds that space itself. Offsets at which tokens of both end cut the bytes
into groups; tokens of a group are linked.

1. Every task aligns its documents and keeps, per pair of ids, how many documents hold
   it. What it kept goes, as packed numbers, to the ``PARTS`` parts of the pairs.
2. A part's distinct pairs meet over a tree of bounded groups and get a minimal perfect
   hash (``perfect_hash``).
3. Each branch of the tree adds its counts into a dense vector indexed by that hash, the
   pair stored at an index being compared with the pair counted; the vectors are summed
   up the tree.
4. A second pass aligns the documents again and looks the counts up by the hash.

The counts reach the second pass as broadcasts of at most ``BLOCK_BYTES``. A corpus with
more pairs than that is passed over once for each block of parts, and the sums of a
document are added up over the blocks, so nothing is left out. The number of pairs has a
bound, the product of the vocabularies.

A text is aligned unit by unit, each distinct unit once per Python worker: a unit is a
stretch that neither tokenizer joins to what stands beside it (``tokens``; for B it is
read off the vocabulary that no piece crosses a cut). Units whose tokens do not give back
their bytes, and texts without such units, go to the libraries as whole texts.

Defined cases: null or empty text, and a text whose tokens of A or B do not give back its
bytes, has no tokens: zeros and an empty ``groups``; a null doc_id is a document like any
other, and repeated rows are documents of their own; other columns are never read; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm import tokens
from docsift.llm.hashing import mixed
from docsift.llm.perfect_hash import PerfectHash
from docsift.llm.rows import ROW, numbered
from docsift.llm.words import small
from docsift.llm.worker import kept
from docsift.session import materialize

PARTS = 128
FAN_IN = 64                  # tasks, or branches, that meet in one group
KEPT_PAIRS = 2_000_000       # pairs a task keeps before it lets them go
BLOCK_BYTES = 64 << 20       # pairs and counts that are broadcast at once
MAX_UNITS = 400_000
JOINED = 4000                # units in one call of the libraries
AT_ONCE = 1 << 20            # links of whole texts expanded at a time
PAIR_BITS = 31               # of a pair as a number (checked against the vocabularies)
NEWLINE = "\n"

KEPT = "part int, leaf bigint, pairs binary, counts binary"
SCHEMA = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
          "count_sum bigint, groups_sha256 string")
_PART_SEED = np.uint64(0x5851F42D4C957F2D)


def _part_of(pairs: np.ndarray) -> np.ndarray:
    return (mixed(pairs.astype(np.uint64) + _PART_SEED) % np.uint64(PARTS)).astype(np.int32)


class Pair:
    """The two tokenizers: ids of texts and bytes of ids."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece

        self.a = tokens.load(byte_path)
        self.a.encode_special_tokens = True                     # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        n = self.a.get_vocab_size()
        self.bytes_a = tokens.bytes_of_tokens(self.a)
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.n_b = len(self.bytes_b)
        if n * self.n_b >= 1 << PAIR_BITS:
            raise ValueError("a pair of ids does not fit in 31 bits")
        self.length_a, self.length_b = (np.array([len(x) for x in xs]) for xs in (self.bytes_a, self.bytes_b))
        self.ranks = tokens.by_ranks(byte_path, self.a)
        self.write = Writer(max(n, self.n_b))
        self.newline_a = self.a.encode("\n", add_special_tokens=False).ids
        self.newline_b = self.b.encode("\n")[1:]
        normal = [self.b.id_to_piece(i) for i in range(self.n_b)
                  if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        self.separate = (len(self.newline_a) == len(self.newline_b) == 1
                         and not any(re.search("[^\u2581]\u2581|\n", p) for p in normal))
        before = {m for p in normal for m in re.findall(r"(.)[.,]", p) if m.isalnum()}
        self.crossed = re.compile("[%s][.,]" % re.escape("".join(sorted(before)))) if before else None

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("\u2581", " ").encode()

    def whole(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both for a space and the text; None where either does not give back its bytes."""
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        return self._checked(a, self.b.encode(text), b" " + text.encode())

    def lines(self, lines: list[str], words: bool) -> tuple[np.ndarray, np.ndarray] | None:
        """The same for lines, with a newline before each and after the last one, and no space added.

        ``words``: every line is one word, so that A does nothing but merge its bytes.
        """
        text = "\n" + "\n".join(lines) + "\n"
        if words and self.ranks:
            a = self.ranks.encode_ordinary(text)
        else:
            a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return self._checked(a, self.b.encode(text)[1:], text.encode())

    def _checked(self, a: list[int], b: list[int], raw: bytes):
        if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def units(self, text: str) -> list[str] | None:
        """Units of a space and the text; None where the libraries need the whole text."""
        if not self.separate or text[0] in ",." or (self.crossed and self.crossed.search(text)):
            return None
        units = tokens.byte_level_units(text)
        if not units or "" in units:
            return None
        units[0] = " " + units[0]
        return units


def groups(a: np.ndarray, b: np.ndarray, pair: Pair) -> tuple[np.ndarray, np.ndarray]:
    """For each token of A and of B, the number of its group."""
    end_a, end_b = np.cumsum(pair.length_a[a]), np.cumsum(pair.length_b[b])
    common = np.intersect1d(end_a, end_b, assume_unique=True)
    return np.searchsorted(common, end_a), np.searchsorted(common, end_b)


def links(a: np.ndarray, group_a: np.ndarray, b: np.ndarray, group_b: np.ndarray, n_b: int) -> Iterator[tuple]:
    """(group, pair, how many links) of each distinct pair of ids in a group, about ``AT_ONCE`` at a time."""
    ga, ia, ma = _distinct(group_a, a)
    gb, ib, mb = _distinct(group_b, b)
    first, last = np.searchsorted(gb, ga, "left"), np.searchsorted(gb, ga, "right")
    sizes = last - first                                        # partners of each distinct token of A
    until = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(until, (until[start - 1] if start else 0) + AT_ONCE, "right")))
        rows = np.repeat(np.arange(start, stop), sizes[start:stop])
        place = np.arange(len(rows)) - np.repeat(np.cumsum(sizes[start:stop]) - sizes[start:stop], sizes[start:stop])
        partner = first[rows] + place
        yield ga[rows], ia[rows] * n_b + ib[partner], ma[rows] * mb[partner]
        start = stop


def _distinct(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    both, counts = _counted(group << 20 | ids)
    return both >> 20, both & (1 << 20) - 1, counts


class Writer:
    """Writes groups as ``a1,a2|b1,b2;...``: an id and the sign after it are one entry of a table."""

    SIGNS = (b",", b"|", b";", b"")

    def __init__(self, n_ids: int):
        self.n_ids = n_ids
        self.table = [b"%d" % i + sign for sign in self.SIGNS for i in range(n_ids)] + [b"\n"]

    def __call__(self, a: np.ndarray, group_a: np.ndarray, b: np.ndarray, group_b: np.ndarray,
                 newline: np.ndarray | None = None) -> bytes:
        """``newline``: groups that are written as a newline, which ends what stands before it."""
        place = np.concatenate([2 * group_a, 2 * group_b + 1])
        order = np.argsort(place, kind="stable")
        place, ids = place[order], np.concatenate([a, b])[order]
        after = np.append(place[1:], place[-1] + 1)
        sign = np.where(after == place, 0, np.where(place & 1 == 0, 1, 2))
        sign[-1] = 3
        entry = sign * self.n_ids + ids
        if newline is not None:
            marked = np.zeros(int(place[-1]) // 2 + 2, bool)
            marked[newline] = True
            entry[(sign == 2) & marked[after >> 1]] += self.n_ids           # no sign before a newline
            entry[marked[place >> 1]] = len(self.table) - 1
            entry = entry[~(marked[place >> 1] & (place & 1 == 1))]         # one newline for the pair of tokens
        return b"".join(map(self.table.__getitem__, entry.tolist()))


def _sorted_distinct(values: np.ndarray) -> np.ndarray:
    """The distinct numbers, rising (sorting is much faster here than ``np.unique``, which hashes)."""
    values = np.sort(values)
    return values[np.flatnonzero(np.diff(values, prepend=values[:1] - 1))] if len(values) else values


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers, rising, and how often each stands in ``values``."""
    values = np.sort(values)
    first = np.flatnonzero(np.diff(values, prepend=values[:1] - 1)) if len(values) else np.zeros(0, np.int64)
    return values[first], np.diff(first, append=len(values))


def _until(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``values`` up to each of ``ends``."""
    return np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[ends]


class _Rising:
    """A numpy array that grows at its end."""

    def __init__(self, dtype=np.int64):
        self._data, self.n = np.zeros(1024, dtype), 0

    def append(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self._data):
            self._data = np.resize(self._data, max(2 * len(self._data), self.n + len(values)))
        self._data[self.n:self.n + len(values)] = values
        self.n += len(values)

    @property
    def values(self) -> np.ndarray:
        return self._data[:self.n]


class Units:
    """Every unit met so far, aligned: its pairs, or its counts of tokens, groups and links and its groups as text.

    When ``MAX_UNITS`` are known, those not met for the longest time make room for new ones.
    """

    COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")

    def __init__(self, pair: Pair, score=None):
        """``score``: (pairs) -> (count, whether it is the best of its A id) of each; None: pairs are all that is kept."""
        self.pair, self.score, self.clock = pair, score, 0
        self._empty()

    def _empty(self) -> None:
        self.number: dict[str, int] = {}
        self.texts: list[bytes | None] = []                     # None: its tokens do not give back its bytes
        self.sums = {c: _Rising() for c in (self.COLUMNS if self.score else self.COLUMNS[:1])}
        self.pairs, self.until, self.met = _Rising(), _Rising(), _Rising()

    def learn(self, units: dict[str, int]) -> np.ndarray:
        """Number of each of ``units``."""
        new = [u for u in units if u not in self.number]
        if len(self.number) + len(new) > MAX_UNITS and self.number:
            self._make_room(units)
            new = [u for u in units if u not in self.number]
        if NEWLINE in units and NEWLINE not in self.number:         # it is what stands between two lines
            new.remove(NEWLINE)
            self._add([NEWLINE], np.array(self.pair.newline_a), np.array(self.pair.newline_b), None)
        words = {u for u in new if tokens.WORD.fullmatch(u)}
        for kind in (True, False):
            some = [u for u in new if (u in words) == kind]
            for start in range(0, len(some), JOINED):
                self._learn(some[start:start + JOINED], kind)
        numbers = np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))
        self.clock += 1
        self.met.values[numbers] = self.clock
        return numbers

    def _make_room(self, wanted: dict[str, int]) -> None:
        """Keeps the half that was met last."""
        met, until, pairs = (x.values for x in (self.met, self.until, self.pairs))
        late = (met > np.median(met)).tolist()
        kept = [(u, i) for u, i in self.number.items() if late[i] or u in wanted]
        at, texts, sums = np.array([i for _, i in kept], np.int64), self.texts, self.sums
        self._empty()
        self.number = {u: k for k, (u, _) in enumerate(kept)}
        self.texts = [texts[i] for _, i in kept] if self.score else []
        for column, values in sums.items():
            self.sums[column].append(values.values[at])
        if not self.score:
            rows, _ = _gathered(at, until)
            self.pairs.append(pairs[rows])
            self.until.append(np.cumsum(np.diff(until, prepend=0)[at]))
        self.met.append(met[at])

    def _learn(self, units: list[str], words: bool) -> None:
        """Aligns new units in one call of each library; a call whose bytes differ is halved until it is one unit."""
        ids = self.pair.lines(units, words)
        if ids:
            self._add(units, *ids, self._newlines(*ids))
        elif len(units) > 1:
            half = len(units) // 2
            self._learn(units[:half], words)
            self._learn(units[half:], words)
        else:
            self.number[units[0]] = len(self.number)
            if self.score:
                self.texts.append(None)
            none = np.zeros(1, np.int64)
            self._add_sums(dict.fromkeys(self.sums, none), none[:0], none)

    def _newlines(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return a == self.pair.newline_a[0], b == self.pair.newline_b[0]

    def _add(self, units: list[str], a: np.ndarray, b: np.ndarray, newlines) -> None:
        """``newlines``: which tokens of A and B are those between units; None where there is one unit."""
        of_a, of_b = groups(a, b, self.pair)
        n, size = int(of_a[-1]) + 1, len(units)
        unit, cuts = np.zeros(n, np.int64), None                            # of each group; -1: between units
        if newlines:
            cuts = of_a[newlines[0]]
            if not np.array_equal(cuts, of_b[newlines[1]]) or len(cuts) != size + 1:
                raise RuntimeError("units and lines differ in number")
            unit = np.searchsorted(cuts, np.arange(n), "right") - 1
            unit[cuts] = -1
        kept, at = unit[unit >= 0], np.arange(size)
        last = np.searchsorted(kept, at, "right")
        self.number.update(zip(units, range(len(self.number), len(self.number) + size)))
        if self.score:
            written = self.pair.write(a, of_a, b, of_b, cuts)
            self.texts += written.split(b"\n")[1:-1] if newlines else [written]

        group, pairs, times = (np.concatenate(x) for x in zip(*links(a, of_a, b, of_b, self.pair.n_b)))
        mine = unit[group] >= 0
        pairs, times, unit_of_pair = pairs[mine], times[mine], unit[group[mine]]
        until = np.searchsorted(unit_of_pair, at, "right")
        sums = {"n_a": (np.bincount(of_a, minlength=n)[unit >= 0], last)}
        if self.score:
            n_a, n_b = sums["n_a"][0], np.bincount(of_b, minlength=n)[unit >= 0]
            count, best = self.score(pairs)
            sums |= {"n_b": (n_b, last), "n_groups": (np.ones(len(kept), np.int64), last), "n_links": (n_a * n_b, last),
                     "n_best": (times * best, until), "count_sum": (times * count, until)}
        self._add_sums({c: np.diff(_until(values, ends), prepend=0) for c, (values, ends) in sums.items()},
                       pairs, np.diff(until, prepend=0))

    def _add_sums(self, sums: dict[str, np.ndarray], pairs: np.ndarray, sizes: np.ndarray) -> None:
        for column, values in sums.items():
            self.sums[column].append(values)
        if not self.score:
            self.until.append(np.cumsum(sizes) + self.pairs.n)
            self.pairs.append(pairs)
        self.met.append(np.zeros(len(sizes), np.int64))

    def split(self, texts: list[str]) -> list[np.ndarray | None]:
        """Numbers of each text's units; None where it has to be aligned whole."""
        place: dict[str, int] = defaultdict()                       # of the units of these texts
        place.default_factory = place.__len__
        cut = []
        for t in texts:
            units = self.pair.units(t) if t else ()
            cut.append(None if units is None else np.fromiter(map(place.__getitem__, units), np.int64, len(units)))
        number = self.learn(place)
        well = self.sums["n_a"].values[number] > 0                  # no token: the bytes differ
        return [None if at is None or not well[at].all() else number[at] for at in cut]

    def pairs_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of units, and which of ``numbers`` each comes from."""
        rows, of = _gathered(numbers, self.until.values)
        return self.pairs.values[rows], of


def _gathered(numbers: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of each of ``numbers`` in an array cut at ``until``, and whose they are."""
    starts = np.where(numbers > 0, until[numbers - 1], 0) if len(numbers) else numbers
    sizes = until[numbers] - starts
    of = np.repeat(np.arange(len(numbers)), sizes)
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(of)), of


# ---- first pass: pairs and how many documents hold them ---------------------------------------------------

def _document_pairs(units: Units, texts: list[str]) -> np.ndarray:
    """The distinct pairs of each text, one after another."""
    split = units.split(texts)
    known = [i for i, s in enumerate(split) if s is not None and len(s)]
    out = []
    if known:
        sizes = [len(split[i]) for i in known]
        held = _sorted_distinct(np.repeat(np.arange(len(known)), sizes) << 32 | np.concatenate([split[i] for i in known]))
        pairs, of = units.pairs_of(held & 0xFFFFFFFF)
        out.append(_sorted_distinct((held >> 32)[of] << PAIR_BITS | pairs) & (1 << PAIR_BITS) - 1)
    for i, s in enumerate(split):
        if s is None and (ids := units.pair.whole(texts[i])):
            held = np.zeros(0, np.int64)
            (a, b), (of_a, of_b) = ids, groups(*ids, units.pair)
            for _, pairs, _ in links(a, of_a, b, of_b, units.pair.n_b):
                held = np.union1d(held, pairs)
            out.append(held)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _added(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs with their counts summed."""
    every, counts = np.concatenate(pairs), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every = every[order]
    first = np.flatnonzero(np.diff(every, prepend=every[:1] - 1))
    return every[first], np.add.reduceat(counts[order], first)


def kept_pairs(docs: DataFrame, tokenizers: tuple[str, str]) -> DataFrame:
    """``KEPT``: per task and part, packed pairs (unsigned 32-bit, rising) and how many of its documents hold each."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _units(tokenizers)
        leaf = TaskContext.get().partitionId()
        pairs, counts, n = [], [], 0

        def packed() -> pa.RecordBatch:
            distinct, total = _added(pairs, counts)
            part = _part_of(distinct)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(PARTS + 1))
            held = [p for p in range(PARTS) if cuts[p] < cuts[p + 1]]
            return _batch(part=(held, pa.int32()), leaf=([leaf] * len(held), pa.int64()),
                          pairs=([distinct[order[cuts[p]:cuts[p + 1]]].astype("<u4").tobytes() for p in held], pa.binary()),
                          counts=([total[order[cuts[p]:cuts[p + 1]]].astype("<i8").tobytes() for p in held], pa.binary()))

        for texts in _texts(batches):
            distinct, count = _counted(_document_pairs(units, texts[1]))
            pairs.append(distinct)
            counts.append(count)
            n += len(distinct)
            if n > KEPT_PAIRS:
                pairs, counts = ([x] for x in _added(pairs, counts))
                if 2 * (n := len(pairs[0])) > KEPT_PAIRS:
                    yield packed()
                    pairs, counts, n = [], [], 0
        if n:
            yield packed()

    return docs.select("text").mapInArrow(keep, KEPT)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], list(columns))


def _table(**columns) -> pa.Table:
    return pa.Table.from_batches([_batch(**columns)])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Rows in slices of about a million characters, with their texts, null as empty."""
    for batch in small(batches):
        texts = pc.fill_null(batch["text"].cast(pa.string()), "").to_pylist()
        for rows in tokens.slices(texts):
            yield batch[rows], texts[rows]


# ---- distinct pairs, hash, dense vectors ------------------------------------------------------------------

def _numbers(column: pa.ChunkedArray, dtype: str) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype) for x in column.to_pylist()]


def _union(group: pa.Table) -> pa.Table:
    """The distinct pairs of a branch."""
    pairs = _sorted_distinct(np.concatenate(_numbers(group["pairs"], "<u4")).astype(np.int64)).astype("<u4")
    return _table(part=([group["part"][0].as_py()], pa.int32()), leaf=([group["leaf"][0].as_py()], pa.int64()),
                  pairs=([pairs.tobytes()], pa.binary()))


def _hashed(group: pa.Table) -> pa.Table:
    """The hash of a part's pairs, and the pairs in the order of their numbers."""
    pairs = _sorted_distinct(np.concatenate(_numbers(group["pairs"], "<u4")).astype(np.int64)).astype("<u4")
    found = PerfectHash.of(pairs)
    ordered = np.empty_like(pairs)
    ordered[found.index(pairs)] = pairs
    return _table(part=([group["part"][0].as_py()], pa.int32()), hash=([found.to_bytes()], pa.binary()),
                  pairs=([ordered.tobytes()], pa.binary()))


def _dense(kept: pa.Table, hashed: pa.Table) -> pa.Table:
    """The counts of a branch as a vector by number; every pair is compared with the one that has its number."""
    if not kept.num_rows:
        return _table(part=([], pa.int32()), leaf=([], pa.int64()), counts=([], pa.binary()))
    ordered = np.frombuffer(hashed["pairs"][0].as_py(), "<u4")
    numbers = PerfectHash.from_bytes(hashed["hash"][0].as_py())
    vector = np.zeros(len(ordered), np.int64)
    for pairs, counts in zip(_numbers(kept["pairs"], "<u4"), _numbers(kept["counts"], "<i8")):
        at = numbers.index(pairs)
        if (at < 0).any() or (ordered[at] != pairs).any():
            raise RuntimeError("the documents changed between two readings")
        vector[at] += counts                                    # pairs of a row are distinct
    return _table(part=([kept["part"][0].as_py()], pa.int32()), leaf=([kept["leaf"][0].as_py()], pa.int64()),
                  counts=([vector.tobytes()], pa.binary()))


def _summed(group: pa.Table) -> pa.Table:
    total = np.sum(_numbers(group["counts"], "<i8"), axis=0)
    return _table(part=([group["part"][0].as_py()], pa.int32()), leaf=([group["leaf"][0].as_py()], pa.int64()),
                  counts=([total.tobytes()], pa.binary()))


def _upward(df: DataFrame) -> DataFrame:
    return df.withColumn("leaf", F.expr(f"leaf div {FAN_IN}"))


def pair_counts(kept: DataFrame) -> DataFrame:
    """``part, hash, pairs, counts``: each part's perfect hash, and pairs and counts in the order of its numbers."""
    branches = ((kept.agg(F.max("leaf")).first()[0] or 0) // FAN_IN) + 1
    distinct, n = kept.select("part", "leaf", "pairs"), branches * FAN_IN
    while n > FAN_IN:
        distinct = _upward(distinct).groupBy("part", "leaf").applyInArrow(_union, "part int, leaf bigint, pairs binary")
        n = -(-n // FAN_IN)
    hashed = materialize(distinct.groupBy("part").applyInArrow(_hashed, "part int, hash binary, pairs binary"), "hashes")
    # each branch needs its part's hash
    copies = hashed.withColumn("leaf", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(branches - 1).cast("bigint"))))
    vectors = _upward(kept).groupBy("part", "leaf").cogroup(copies.groupBy("part", "leaf")).applyInArrow(
        _dense, "part int, leaf bigint, counts binary")
    while branches > 1:
        vectors = _upward(vectors).groupBy("part", "leaf").applyInArrow(_summed, "part int, leaf bigint, counts binary")
        branches = -(-branches // FAN_IN)
    return hashed.join(vectors.select("part", "counts"), "part")


# ---- second pass: look the counts up ----------------------------------------------------------------------

class Counts:
    """Counts of pairs for the parts at hand, and the highest count of each A id."""

    def __init__(self, parts: list, best: np.ndarray, n_b: int):
        self.parts = {p["part"]: (PerfectHash.from_bytes(p["hash"]), np.frombuffer(p["pairs"], "<u4"),
                                  np.frombuffer(p["counts"], "<i8")) for p in parts}
        self.best, self.n_b = best, n_b

        self.known, self.known_counts = np.zeros(0, np.int64), np.zeros(0, np.int64)     # looked up before, rising

    def __call__(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count, and whether it is its A id's highest; 0 and False for pairs of other parts."""
        at = np.searchsorted(self.known, pairs)
        new = np.flatnonzero(np.append(self.known, -1)[at] != pairs)
        if len(new):
            if len(self.known) > KEPT_PAIRS:
                self.known, self.known_counts, new = self.known[:0], self.known_counts[:0], np.arange(len(pairs))
            self._look_up(_sorted_distinct(pairs[new]))
            at = np.searchsorted(self.known, pairs)
        count = self.known_counts[at]
        return count, (count > 0) & (count == self.best[pairs // self.n_b])

    def _look_up(self, distinct: np.ndarray) -> None:
        part, count = _part_of(distinct), np.zeros(len(distinct), np.int64)
        for p in np.unique(part).tolist():
            if p in self.parts:
                numbers, ordered, counts = self.parts[p]
                mine = np.flatnonzero(part == p)
                number = numbers.index(distinct[mine])
                if (number < 0).any() or (ordered[number] != distinct[mine]).any():
                    raise RuntimeError("the documents changed between two readings")
                count[mine] = counts[number]
        place = np.searchsorted(self.known, distinct)
        self.known = np.insert(self.known, place, distinct)
        self.known_counts = np.insert(self.known_counts, place, count)


def _aligned(units: Units, texts: list[str]) -> Iterator[tuple]:
    """The columns of ``SCHEMA`` after doc_id for each text."""
    split = units.split(texts)
    known = [s for s in split if s is not None]
    ends = np.cumsum([len(s) for s in known], dtype=np.int64)
    numbers = np.concatenate(known) if known else np.zeros(0, np.int64)
    sums = zip(*(np.diff(_until(units.sums[c].values[numbers], ends), prepend=0).tolist() for c in units.COLUMNS))
    for text, s in zip(texts, split):
        if s is not None:
            row, written = next(sums), b";".join(map(units.texts.__getitem__, s.tolist()))
            yield *row, hashlib.sha256(written).hexdigest() if written else ""
        elif ids := units.pair.whole(text):
            yield _whole(ids, units)
        else:
            yield 0, 0, 0, 0, 0, 0, ""


def _whole(ids: tuple[np.ndarray, np.ndarray], units: Units) -> tuple:
    (a, b), (of_a, of_b) = ids, groups(*ids, units.pair)
    n = int(of_a[-1]) + 1
    n_links = int((np.bincount(of_a, minlength=n) * np.bincount(of_b, minlength=n)).sum())
    n_best = count_sum = 0
    for _, pairs, times in links(a, of_a, b, of_b, units.pair.n_b):
        count, best = units.score(pairs)
        n_best += int((times * best).sum())
        count_sum += int((times * count).sum())
    written = hashlib.sha256(units.pair.write(a, of_a, b, of_b)).hexdigest()
    return len(a), len(b), n, n_links, n_best, count_sum, written


def _units(tokenizers: tuple[str, str], name: str = "", counts=None) -> Units:
    """One per Python worker and pass."""
    def make() -> Units:
        pair = Pair(*tokenizers)
        return Units(pair, counts and Counts(*counts.value, pair.n_b))

    return kept((tokenizers, name), make)


def _looked_up(docs: DataFrame, tokenizers: tuple[str, str], parts: list, best: np.ndarray, row: list[str]) -> DataFrame:
    """``SCHEMA`` for every row, its last columns over the given parts of the pairs; ``row``: more columns to keep."""
    counts = docs.sparkSession.sparkContext.broadcast((parts, best))
    name = uuid.uuid4().hex

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _units(tokenizers, name, counts)
        for batch, texts in _texts(batches):
            columns = zip(*_aligned(units, texts))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c) for c in columns), *(batch[c] for c in row)],
                [f.split()[0] for f in SCHEMA.split(", ")] + row)

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *row)
    return given.mapInArrow(look_up, SCHEMA + "".join(f", {c} bigint" for c in row))


def align(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """``SCHEMA`` for every row of ``docs(doc_id, text)``; ``byte_level``, ``pieces``: files of tokenizers A and B."""
    tokenizers = (byte_level, pieces)
    counted = materialize(pair_counts(materialize(kept_pairs(docs, tokenizers), "kept")), "counts")
    sizes = counted.selectExpr("part", "length(hash) + length(pairs) + length(counts) AS n").collect()   # PARTS rows
    blocks, room = [[]], BLOCK_BYTES
    for r in sorted(sizes, key=lambda r: r["part"]):
        if r["n"] > room and blocks[-1]:
            blocks.append([])
            room = BLOCK_BYTES
        blocks[-1].append(r["part"])
        room -= r["n"]
    best = _best(counted, Pair(*tokenizers))
    if len(blocks) > 1:
        docs = numbered(docs)
    results = []
    for block in blocks:
        parts = [r.asDict() for r in counted.filter(F.col("part").isin(block)).collect()]       # BLOCK_BYTES at most
        if len(blocks) == 1:
            return _looked_up(docs, tokenizers, parts, best, [])
        results.append(materialize(_looked_up(docs, tokenizers, parts, best, [ROW]), "looked-up"))
    out, sums = results[0], ["n_best", "count_sum"]
    for more in results[1:]:
        added = more.select(ROW, *[F.col(c).alias(f"{c}_more") for c in sums])
        out = out.join(added, ROW).withColumns({c: F.col(c) + F.col(f"{c}_more") for c in sums}).drop(
            *[f"{c}_more" for c in sums])
    return out.select(*[f.split()[0] for f in SCHEMA.split(", ")])


def _best(counted: DataFrame, pair: Pair) -> np.ndarray:
    """The highest count of each A id; bounded by A's vocabulary."""
    n_b = pair.n_b

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs, counts in zip(_numbers(batch["pairs"], "<u4"), _numbers(batch["counts"], "<i8")):
                ids = pairs // n_b
                order = np.argsort(ids, kind="stable")
                at = np.flatnonzero(np.diff(ids[order], prepend=-1))
                yield _batch(a=(ids[order][at].astype(np.int64), pa.int64()),
                             n=(np.maximum.reduceat(counts[order], at), pa.int64()))

    best = np.zeros(len(pair.bytes_a), np.int64)
    for r in counted.select("pairs", "counts").mapInArrow(highest, "a bigint, n bigint").groupBy("a").agg(
            F.max("n").alias("n")).collect():
        best[r["a"]] = r["n"]
    return best
