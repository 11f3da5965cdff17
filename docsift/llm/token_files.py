"""Token ids as ORC files in ascending document order.

``write`` range-partitions the documents by doc_id, encodes them and writes one
ORC file per range: ids as an integer list (ORC's run-length encoding), row
indexes every ``INDEX_STRIDE`` rows and a Bloom filter on doc_id in each stripe.
Every row also carries its file's place in the order (``part``) and its offset
within that file (``at``), so a reader finds where a document starts in the whole
stream from the few file totals, without a global sort or window. Stripes are
read in parallel; ``find`` reads only stripes and row groups whose statistics and
Bloom filters admit the wanted ids.

Defined cases: null text is an empty document (end id only); null doc_id comes
first, as in Spark's ascending order; rows with equal doc_id keep no particular
order among themselves; other columns are never read; an empty table gives no
rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsift.llm import tokens
from docsift.llm.words import small

ROW = "part int, at bigint, doc_id bigint, n_tokens bigint, ids array<int>"
INDEX_STRIDE = 1000
STRIPE_BYTES = 16 << 20


def _encoded(tokenizer: str, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = tokens.word_level(tokenizer), TaskContext.get().partitionId(), 0
        for batch in small(batches):
            texts = pc.fill_null(batch["text"].cast(pa.string()), "").to_pylist()
            for rows in tokens.slices(texts):
                ids, ends = encoder.ids_and_end(texts[rows], end_id)
                n = np.diff(ends, prepend=0)
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.view("<i4")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part), pa.int32()), pa.array(at + ends - n), batch["doc_id"][rows],
                     pa.array(n), ids], ["part", "at", "doc_id", "n_tokens", "ids"])
                at += int(ends[-1])

    return encode


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode ``docs(doc_id, text)`` and write them under ``path`` in ascending doc_id order."""
    ordered = (docs.selectExpr("cast(doc_id as bigint) doc_id", "text")
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id"))
    (ordered.mapInArrow(_encoded(tokenizer, end_id), ROW).write
     .option("orc.stripe.size", STRIPE_BYTES).option("orc.row.index.stride", INDEX_STRIDE)
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01)
     .option("compression", "zstd").orc(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids."""
    rows = spark.read.schema(ROW).orc(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))        # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("first"))
    return (rows.join(F.broadcast(firsts), "part")
            .select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids"))


def find(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of a few documents; stripes that cannot hold them are skipped."""
    return spark.read.schema(ROW).orc(path).filter(F.col("doc_id").isin(doc_ids)).select("doc_id", "n_tokens", "ids")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch["ids"]
        raw = np.asarray(ids.values, dtype="<i4")
        ends = ids.offsets.to_numpy()
        crc = [zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["start"], pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"])


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the little-endian 32-bit ids, all from the files."""
    return read(spark, path).mapInArrow(_checksums, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
