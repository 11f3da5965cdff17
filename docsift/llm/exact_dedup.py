"""Exact dedup: two-pass Bloom filtering, built-in expressions only.

Texts are equal when identical after deleting the six ASCII white-space
characters (null counts as empty). One pass over the text leaves a narrow table
(row, doc_id, hash, length). On that table:

* pass 1 sets, per row, ``HASHES`` positions of a Bloom filter and keeps the
  positions that at least two rows set (counts are summed map-side first), as
  4 KB bitmaps;
* pass 2 tests every row against those bitmaps. A row with a position that only
  it set is unique for certain and passes straight through; the others (true
  repeats plus a few false positives) shuffle by hash and are grouped exactly.

The filter never exceeds ``MAX_BITS`` bits (the bitmaps are broadcast: 64 MB at
most, for some 300 million rows). A fuller filter only lets more unique rows into the
shuffle (half of them at 300 million rows, almost all beyond a billion); the result does
not depend on it.

Defined cases: null doc_id sorts after all others; rows repeated in every column
form one group, of which exactly one row stays; an empty table gives an empty
result; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.rows import numbered, row_of, without_rows
from docsift.session import materialize

HASHES = 2
MAX_BITS = 1 << 29
BITS_PER_ROW = 16
BUCKET_BITS = 32768          # bits in one bitmap_construct_agg bitmap
HOT_GROUPS = 1000            # at most so many groups hold 1/HOT_GROUPS of the rows or more each


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _positions(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def _bit_set(bitmap: Column, pos: Column) -> Column:
    bit = F.pmod(pos, F.lit(BUCKET_BITS)).cast("int")
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, bit % 8).bitwiseAND(F.lit(1)) == 1


def repeated_positions(rows: DataFrame, key: str, bits: int) -> DataFrame:
    """Pass 1: ``(bucket, bitmap)`` of the positions that two or more rows set."""
    pos = rows.select(F.explode(F.array(*_positions(F.col(key), bits))).alias("pos"))
    twice = pos.groupBy("pos").agg(F.count("*").alias("n")).filter("n > 1")
    return (twice.groupBy(F.expr(f"pos div {BUCKET_BITS}").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.pmod("pos", F.lit(BUCKET_BITS))).alias("bitmap")))


def possibly_repeated(rows: DataFrame, key: str, n_rows: int) -> DataFrame:
    """Pass 2: ``rows`` with a boolean ``maybe``; false only for keys that occur once."""
    bits = BUCKET_BITS
    while bits < min(n_rows * BITS_PER_ROW, MAX_BITS):
        bits *= 2
    filt = materialize(repeated_positions(rows, key, bits), "bloom")
    out, maybe = rows, F.lit(True)
    for i, pos in enumerate(_positions(F.col(key), bits)):
        f = F.broadcast(filt.select(F.col("bucket").alias(f"_b{i}"), F.col("bitmap").alias(f"_m{i}")))
        out = out.withColumn(f"_p{i}", pos)
        out = out.join(f, F.expr(f"_p{i} div {BUCKET_BITS}") == F.col(f"_b{i}"), "left")
        maybe = maybe & F.coalesce(_bit_set(F.col(f"_m{i}"), F.col(f"_p{i}")), F.lit(False))
        out = out.withColumn("maybe", maybe).drop(f"_b{i}", f"_m{i}")
        maybe = F.col("maybe")
    return out.drop(*[f"_p{i}" for i in range(HASHES)])


def _decided(docs: DataFrame) -> DataFrame:
    """row, doc_id, keep_id, keep_row, group_size, sha."""
    text = F.col("text")
    narrow = materialize(docs.select(
        row_of(docs).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.length(text), F.lit(0)).alias("n"),
        F.unhex(F.sha2(normalised(text), 256)).alias("sha")), "hashes")
    n_rows = narrow.count()
    tested = materialize(possibly_repeated(narrow, "sha", n_rows), "tested")
    maybe = tested.filter("maybe")

    best = F.min(F.struct(-F.col("n"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))).alias("best")
    groups = materialize(
        maybe.groupBy("sha").agg(best, F.count("*").alias("group_size"))
        .select("sha", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size"),
        "groups")
    # the few groups that hold a large share of the rows go to the rows, not the rows to one task
    hot_from = n_rows // HOT_GROUPS + 1
    hot, cold = (groups.filter(F.col("group_size") > hot_from), groups.filter(F.col("group_size") <= hot_from))
    rows = maybe.select("row", "doc_id", "sha")
    found = rows.join(F.broadcast(hot), "sha").unionByName(
        rows.join(F.broadcast(hot.select("sha")), "sha", "left_anti").join(cold, "sha"))
    alone = tested.filter("NOT maybe").select(
        "sha", "row", "doc_id", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"),
        F.lit(1).cast("bigint").alias("group_size"))
    return found.unionByName(alone)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs(doc_id, text)``."""
    return _decided(docs).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of the table ``docs`` that stay, with all their columns."""
    docs = numbered(docs)
    return without_rows(docs, _decided(docs).filter("row <> keep_row"))
