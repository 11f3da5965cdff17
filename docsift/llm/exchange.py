"""Packed key exchange: which of a chunk's keys do other chunks hold?

Rows are dealt to *chunks* of ``CHUNK_ROWS`` neighbours. A task boils a chunk down
to its distinct 64-bit keys, sorted, and sends each key range (*part*) one binary
block. A part joins the blocks of all chunks and answers each block with one bit
per key, in the order of the keys. So a key that every document holds arrives
once per chunk, no matter how hot it is, and an answer is an eighth of a byte.

``docs`` must give the same rows in the same partitions when it is read again (a
table does); an answer that does not fit its chunk raises.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.rows import row_of
from docsift.llm.worker import begin
from docsift.session import materialize

CHUNK_ROWS = 1024
PART_BYTES = 8 << 20                # text per part
BLOCK = "chunk bigint, part int, block binary"
LAST = np.iinfo(np.int64).max       # the place of a null doc_id in the order


def chunked(docs: DataFrame) -> DataFrame:
    """chunk, row, doc_id, text (as UTF-8, null as empty)."""
    place = F.monotonically_increasing_id()
    return docs.select(F.floor(place / CHUNK_ROWS).alias("chunk"), row_of(docs).alias("row"),
                       F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def n_parts(docs: DataFrame, part_bytes: int | None = None) -> int:
    """Key ranges for the text that there is."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"]
    return max(1, -(-(size or 0) // (part_bytes or PART_BYTES)))


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table, and the shuffle files that made it given up.

    Spark deletes a finished job's shuffle files once the driver's JVM has collected its plan; asking for
    that now keeps the disk at one step's files instead of the sum of all steps.
    """
    out = materialize(df, name)
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """A table per chunk, from batches in which the rows of a chunk follow each other."""
    begin()
    held: list[pa.RecordBatch] = []
    at = None
    for batch in batches:
        chunk = batch["chunk"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and chunk[a] != at:
                yield pa.Table.from_batches(held)
                held = []
            at = chunk[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def order_ids(column) -> np.ndarray:
    return np.asarray(column.fill_null(LAST)).astype(np.int64)


def part_bounds(keys: np.ndarray, parts: int) -> list[int]:
    """Where each part's keys start in sorted ``keys``, and their end."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64)).tolist()


def blocks(chunk: int, keys: np.ndarray, planes: list[np.ndarray], parts: int) -> Iterator[tuple[int, int, bytes]]:
    """(chunk, part, block) of each part that gets keys; a block holds the planes' slices one after another."""
    bounds = part_bounds(keys, parts)
    for part, (a, b) in enumerate(zip(bounds, bounds[1:])):
        if a < b:
            yield chunk, part, b"".join(p[a:b].tobytes() for p in planes)


def block_batch(rows) -> pa.RecordBatch:
    """Blocks as a batch of ``BLOCK`` rows."""
    chunk, part, block = zip(*rows) if (rows := list(rows)) else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk, pa.int64()), pa.array(part, pa.int32()), pa.array(block, pa.binary())],
        ["chunk", "part", "block"])


def unpacked(raw: list[bytes], kinds: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """The planes of all blocks, joined, and how many keys each block has."""
    begin()
    kinds = [np.dtype(k) for k in kinds]
    each = sum(k.itemsize for k in kinds)
    counts = np.array([len(b) // each for b in raw], np.int64)
    planes: list[list[np.ndarray]] = [[] for _ in kinds]
    for b, n in zip(raw, counts.tolist()):
        at = 0
        for plane, kind in zip(planes, kinds):
            plane.append(np.frombuffer(b, kind, n, at))
            at += n * kind.itemsize
    return [np.concatenate(p) if p else np.zeros(0, k) for p, k in zip(planes, kinds)], counts


def answers(sent: DataFrame, kinds: list[str], decide: Callable[..., np.ndarray]) -> DataFrame:
    """chunk, part, block: for each block sent, ``decide(*planes)`` of all keys of its part as bits."""
    def answer(table: pa.Table) -> pa.Table:
        planes, counts = unpacked(table["block"].to_pylist(), kinds)
        bits = np.split(decide(*planes), np.cumsum(counts)[:-1])
        return pa.table([table["chunk"], table["part"],
                         pa.array([np.packbits(b).tobytes() for b in bits], pa.binary())], ["chunk", "part", "block"])

    return sent.groupBy("part").applyInArrow(answer, BLOCK)


def answered(keys: np.ndarray, replies: pa.Table, parts: int) -> np.ndarray:
    """The answers to a chunk's sorted ``keys`` as booleans."""
    out = np.zeros(len(keys), bool)
    bounds = part_bounds(keys, parts)
    got = dict(zip(replies["part"].to_pylist(), replies["block"].to_pylist()))
    for part, (a, b) in enumerate(zip(bounds, bounds[1:])):
        if a < b:
            if len(got.get(part, b"")) != -(-(b - a) // 8):
                raise RuntimeError("the documents changed between two readings; write them to a table first")
            out[a:b] = np.unpackbits(np.frombuffer(got[part], np.uint8), count=b - a).astype(bool)
    return out


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts ``keys``, the starts of equal ones in it, and each sorted key's group."""
    order = np.argsort(keys)
    s = keys[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def rounds(*replies: DataFrame) -> DataFrame:
    """The replies of several rounds as one table, told apart by ``round``."""
    out = None
    for i, r in enumerate(replies):
        r = r.select("chunk", "part", "block", F.lit(i).alias("round"))
        out = r if out is None else out.unionByName(r)
    return out


def of_round(replies: pa.Table, i: int) -> pa.Table:
    return replies.filter(pc.equal(replies["round"], i))


def covered(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of ``n`` places lie in a window of ``width`` from one of ``starts``."""
    steps = np.zeros(n + width + 1, np.int32)
    steps[starts] += 1
    np.subtract.at(steps, starts + width, 1)
    return np.cumsum(steps)[:n] > 0
