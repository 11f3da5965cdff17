"""Best-fit packing with certified bounds.

Documents become token pieces of at most ``capacity`` ids (only longer ones are
cut; the first piece takes the remainder). A piece that fills a sequence has it
to itself. The others are dealt at random to groups of a bounded number of
pieces, and each group runs best-fit decreasing. Dual feasible functions over
the group's length histogram give a lower bound on its bins: a group that meets
it is certified optimal. A group with a gap hands the pieces of its non-full bins
over, a certified one only its emptiest bin; these are dealt anew (fewer groups,
other neighbours) and packed again, for ``ROUNDS`` rounds.

Defined cases: null or empty text is one piece holding the end id; null doc_id and
repeated rows are pieces like any other; other columns are never read; an empty
table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm import tokens
from docsift.llm.words import small
from docsift.session import materialize

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
GROUP_PIECES = 20_000
ROUNDS = 3
_BINS = 1 << 24            # sequence numbers set aside for a group
_GROUPS = 1 << 32          # group numbers set aside for a round


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Token pieces of ``docs(doc_id, text)``: where each lies in its document, and a checksum of its ids."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.byte_level(tokenizer)
        for batch in small(batches):
            texts = pc.fill_null(batch["text"].cast(pa.string()), "").to_pylist()
            for rows in tokens.slices(texts):
                at, piece, starts, lengths, crcs = [], [], [], [], []
                ids, ends = encoder.ids_and_end(texts[rows], end_id)
                stream, ends = memoryview(ids.tobytes()), ends.tolist()
                for i, (first, last) in enumerate(zip([0, *ends], ends)):
                    raw, n = stream[4 * first:4 * last], last - first
                    bounds = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                    for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                        at.append(i)
                        piece.append(k)
                        starts.append(a)
                        lengths.append(b - a)
                        crcs.append(zlib.crc32(raw[4 * a:4 * b]))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][rows].take(pa.array(at, pa.int32())), pa.array(piece, pa.int32()),
                     pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(cut, PIECE)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of two families of dual feasible functions."""
    sizes, counts = np.unique(lengths, return_counts=True)
    if not len(sizes):
        return 0
    best = -(-int(sizes @ counts) // capacity)
    # f_t: over capacity - t counts as full, under t as nothing
    for t in np.unique(np.concatenate([sizes[sizes <= capacity // 2], capacity + 1 - sizes[sizes > capacity // 2]])):
        f = np.where(sizes > capacity - t, capacity, np.where(sizes < t, 0, sizes))
        best = max(best, -(-int(f @ counts) // capacity))
    # u_k: (k+1) x / capacity rounded down, in k-ths, unless it is whole
    for k in range(1, 21):
        whole = (k + 1) * sizes % capacity == 0
        f = np.where(whole, sizes * k, (k + 1) * sizes // capacity * capacity)     # in units of capacity * k
        best = max(best, -(-int(f @ counts) // (capacity * k)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, and the room left in each bin."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]     # bins by room left
    rooms = 0                                                          # bit r: some bin has room r
    room: list[int] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = rooms >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1                    # the tightest room that is enough
            b = with_room[r].pop()
            if not with_room[r]:
                rooms ^= 1 << r
        else:
            r, b = capacity, len(room)
            room.append(capacity)
        bins[i], offsets[i] = b, capacity - r
        room[b] = left = r - n
        if left:
            if not with_room[left]:
                rooms |= 1 << left
            with_room[left].append(b)
    return bins, offsets, np.array(room, np.int64)


def _pack_group(capacity: int, round_no: int, last: bool):
    def pack(table: pa.Table) -> pa.Table:
        lengths = table["length"].to_numpy()
        bins, offsets, room = best_fit_decreasing(lengths, capacity)
        gap = len(room) - lower_bound(lengths, capacity)
        if last:
            over = np.zeros(len(room), bool)
        elif gap:
            over = room > 0
        else:
            over = (np.arange(len(room)) == room.argmax()) & (room > 0)
        group = table["group"].to_numpy()
        return (table.drop_columns(["group"])
                .append_column("sequence_id", pa.array((round_no * _GROUPS + group) * _BINS + bins))
                .append_column("offset", pa.array(offsets)).append_column("handed_over", pa.array(over[bins])))

    return pack


def pack(items: DataFrame, capacity: int, group_pieces: int = GROUP_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """``items`` (with a long ``length`` of at most ``capacity``) plus sequence_id and offset."""
    names = items.columns
    schema = ", ".join(f"`{c}` {t}" for c, t in items.dtypes if c != "length") + (
        ", length bigint, row bigint, sequence_id bigint, offset bigint, handed_over boolean")
    rest = materialize(items.withColumn("row", F.monotonically_increasing_id()), "items")
    out = [rest.filter(F.col("length") >= capacity)
           .select(*names, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))]
    rest = rest.filter(F.col("length") < capacity)
    for k in range(rounds):
        n = rest.count()
        if not n:
            break
        last = k == rounds - 1 or n <= group_pieces // 20
        groups = -(-n // group_pieces)
        dealt = rest.select(*[c for c in names if c != "length"], "length", "row").withColumn(
            "group", F.pmod(F.xxhash64("row", F.lit(k)), F.lit(groups)))
        packed = materialize(dealt.groupBy("group").applyInArrow(_pack_group(capacity, k, last), schema), f"packed{k}")
        out.append(packed.filter("NOT handed_over").select(*names, "sequence_id", "offset"))
        if last:
            break
        rest = packed.filter("handed_over").drop("sequence_id", "offset", "handed_over")
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document."""
    return pack(pieces(docs, tokenizer, end_id, capacity), capacity)
