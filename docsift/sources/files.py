"""Document sources: files, page tables, manifests and request strings.

PDF byte parsing is not built (a per-row native codec). Documents enter either
as a page table ``(doc, page_no, text)`` - whatever produced the text - or as
files read with Spark's ``binaryFile`` source, hashed on the executors.
"""

from __future__ import annotations

from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift import schema as S
from docsift.session import materialize

ERR_ZERO_PAGES = "ZERO_PAGES"
ERR_SCHEMA = "SCHEMA_ERROR"


def _reader(spark: SparkSession, glob: str | None):
    reader = spark.read.format("binaryFile")
    return reader.option("pathGlobFilter", glob) if glob else reader


def _empty_files(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    """The files of length 0 under ``path``, which ``binaryFile`` gives no row for (from the listing)."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    files = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listFiles(root, True)
    rows = []
    while files.hasNext():
        f = files.next()
        if f.getLen() == 0 and fnmatch(f.getPath().getName(), glob or "[!._]*"):
            rows.append((f.getPath().toString(), 0, f.getModificationTime()))
    listed = spark.createDataFrame(rows, "path string, length long, millis long")
    return listed.select("path", "length", F.timestamp_millis("millis").alias("modificationTime"))


def _hashed(content: DataFrame) -> DataFrame:
    return content.select("path", "length", "modificationTime", S.content_hash(F.col("content")).alias("content_hash"))


def scan_files(spark: SparkSession, path: str, *, glob: str | None = None) -> DataFrame:
    """``path, length, modificationTime, content_hash`` for every file under ``path``.

    ``binaryFile`` loads each file whole (2 GB limit per file); the content
    column is pruned right after hashing, so only the hash leaves the task.
    """
    empty = _empty_files(spark, path, glob).withColumn("content", F.lit("").cast("binary"))
    return _hashed(_reader(spark, glob).load(path).select("path", "length", "modificationTime", "content")
                   .unionByName(empty))


def new_files(listing: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Files of a listing not yet in the ledger, keyed on (path, length, modificationTime).

    Unlike an in-process memo keyed on the path alone, a changed file is seen
    as new and hashed again.
    """
    if ledger is None:
        return listing
    return listing.join(ledger.select("path", "length", "modificationTime"),
                        ["path", "length", "modificationTime"], "left_anti")


def first_page(pages: DataFrame, *, doc: str = "doc_id", page: str = "page_no",
               text: str = "text", first: int | None = None) -> DataFrame:
    """First page's text per document: its lowest page number, or the page numbered ``first`` if that is known.

    The lowest numbers are found on the two narrow columns (pre-aggregated, so a document with very many
    pages sends one number per task); texts are fetched for those pages only. With ``first`` it is a filter
    that reaches the scan.
    """
    if first is not None:
        return pages.filter(F.col(page) == first).select(doc, text)
    lowest = pages.groupBy(doc).agg(F.min(page).alias(page))
    return pages.select(doc, page, text).join(lowest, [doc, page], "left_semi").select(doc, text)


def zero_page_errors(docs: DataFrame, pages: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """Documents with no page at all: dead-letter rows ``doc, error_class, error_message``."""
    # distinct page owners first: a document with a third of all pages collapses map-side
    return (docs.select(doc).distinct()
            .join(pages.select(doc).distinct(), doc, "left_anti")
            .select(doc, F.lit(ERR_ZERO_PAGES).alias("error_class"),
                    F.concat(F.lit("document has 0 pages: "), F.col(doc).cast("string")).alias("error_message")))


PIECE_END = "}"
_PLACE = ["file", "block", "at"]


def placed_pieces(spark: SparkSession, path: str | list[str], end: str) -> DataFrame:
    """``file, size, block, at, piece`` of text files cut after each ``end``, in a table of their own.

    Files are split as any text file, so no task needs a whole one. In the order of ``file, block, at`` the pieces
    are the files' text, the files in the order of their names.
    """
    return materialize(spark.read.option("lineSep", end).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("piece")), "pieces", lean=True)


def with_sum_before(pieces: DataFrame, value: str, name: str) -> DataFrame:
    """``pieces`` plus ``name``: the sum of ``value`` over all pieces before each one.

    Within a file split it is a window; what the splits before add is summed over a table of one row a split.
    """
    splits = pieces.groupBy("file", "block").agg(F.sum(value).alias("_of_split"))
    until = F.sum("_of_split").over(Window.orderBy("file", "block"))
    before = splits.select("file", "block", (until - F.col("_of_split")).alias("_before"))
    in_split = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return (pieces.withColumn("_in_split", F.coalesce(F.sum(value).over(in_split), F.lit(0)))
            .join(F.broadcast(before), ["file", "block"])
            .withColumn(name, F.col("_before") + F.col("_in_split")).drop("_before", "_in_split"))


def _count(text, sign: str):
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _step(outside):
    """How much deeper a piece leads, by its brackets; ``outside``: the piece without strings."""
    return _count(outside, "{") + _count(outside, "[") - _count(outside, "]")


def _array_entries(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``entry, object`` of a JSON array of objects in any layout, cut by many tasks; entries count from 0.

    The files are cut after each closing brace, and each piece is read under both assumptions, that it starts
    within a string or not. Which holds follows from the number of quotes before it; its brackets outside strings
    add up to the depth at its end; a brace that leads back to depth one ends an entry. So the state at any place
    is a sum over what stands before, and an entry is put together from its own pieces alone.
    """
    pieces = placed_pieces(spark, path, PIECE_END)
    files = pieces.groupBy("file", "size").agg(
        F.sum(F.octet_length("piece") + 1).alias("_bytes"), F.max(F.struct("block", "at")).alias("_last"))
    # the last piece of a file has no brace after it, unless the file ends with one
    open_end = (F.struct("block", "at") == F.col("_last")) & (F.col("_bytes") != F.col("size"))
    rest = r'[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|\z)'                 # of a string, to its end or the piece's
    bare = F.regexp_replace("piece", r"[ \t\r\n]+", "")
    from_inside = F.regexp_replace("piece", f"(?s)\\A{rest}", "")
    states = materialize(pieces.join(F.broadcast(files.drop("size")), "file").select(
        *_PLACE, (~open_end).alias("closed"),
        _count(F.regexp_replace("piece", r"(?s)\\.", ""), '"').alias("quotes"),
        _step(F.regexp_replace("piece", f'(?s)"{rest}', "")).alias("step_outside"),
        _step(F.regexp_replace(from_inside, f'(?s)"{rest}', "")).alias("step_inside"),
        F.length(bare).alias("n_bare"), F.substring(bare, 1, 2).alias("bare")), "states")
    placed = with_sum_before(states, "quotes", "quotes_before")
    brace = F.col("closed") & ((F.col("quotes_before") + F.col("quotes")) % 2 == 0)
    step = F.when(F.col("quotes_before") % 2 == 1, F.col("step_inside")).otherwise(F.col("step_outside"))
    placed = with_sum_before(placed.withColumn("brace", brace).withColumn("step", step - F.col("brace").cast("int")),
                             "step", "depth")
    ends = F.col("brace") & (F.col("depth") + F.col("step") == 1)
    placed = materialize(with_sum_before(placed.withColumn("ends", ends.cast("int")), "ends", "entry"), "placed")
    seen = placed.agg(F.sum("ends").alias("n"), F.sum("quotes").alias("quotes"), F.sum("step").alias("depth")).first()
    n = seen["n"] or 0
    tail = placed.filter(F.col("entry") == n).agg(
        F.sum("n_bare").alias("size"), F.max("bare").alias("text"), F.max("closed").alias("closed")).first()
    if (seen["depth"], (seen["quotes"] or 0) % 2, tail["closed"], tail["size"], tail["text"]) != (
            0, 0, False, 1 if n else 2, "]" if n else "[]"):
        raise ValueError(f"{path} is not a JSON array")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*_PLACE, "piece", "closed"))), lambda p: F.concat(
        p["piece"], F.when(p["closed"], F.lit(PIECE_END)).otherwise(F.lit("")))), "")
    lead = F.when(F.col("entry") == 0, F.regexp_extract("text", r"(?s)\A[ \t\r\n]*\[[ \t\r\n]*(\{.*)\z", 1)).otherwise(
        F.regexp_extract("text", r"(?s)\A[ \t\r\n]*,[ \t\r\n]*(\{.*)\z", 1))
    whole = placed.filter(F.col("entry") < n).select(*_PLACE, "closed", "entry").join(pieces, _PLACE)
    return whole.groupBy("entry").agg(text.alias("text")).select("entry", lead.alias("object"))


def read_manifest(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A manifest written as one JSON array of ``{label, extraction_schema, pdf_path}``, in any layout and size.

    Entries are parsed with an explicit schema - never inferred, since every entry
    names its own fields. ``job_id`` is the 1-based position in the array. A manifest
    that is no valid JSON array of objects fails the query. The files of a folder or of several, in the order
    of their full names, are one array. Only an entry has to fit in memory.
    """
    wrapped = F.concat(F.lit('{"v":'), F.col("object"), F.lit(',"end":1}'))
    schema = T.StructType([T.StructField("v", S.MANIFEST_ENTRY), T.StructField("end", T.IntegerType())])
    parsed = F.from_json(wrapped, schema, {"mode": "FAILFAST", "allowSingleQuotes": "false"})
    checked = F.when((F.col("object") != "") & (parsed["end"] == 1), parsed["v"]).otherwise(
        F.raise_error(F.lit("the manifest is not a JSON array")).cast(S.MANIFEST_ENTRY))
    return _array_entries(spark, path).select((F.col("entry") + 1).alias("job_id"), checked.alias("e")).select(
        "job_id", F.col("e.label").alias("label"),
        S.dedupe_fields(S.fields_of(F.col("e.extraction_schema"))).alias("fields"),
        F.col("e.pdf_path").alias("doc_id"))


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Jobs as JSON lines (one job per line; splits across tasks), explicit schema.

    A line that is no valid job keeps its row with null columns and ``error_class`` ``SCHEMA_ERROR``.
    """
    schema = "job_id long, label string, extraction_schema map<string,string>, pdf_path string"
    bad = "_malformed"
    df = spark.read.schema(f"{schema}, {bad} string").option("columnNameOfCorruptRecord", bad).json(path)
    return df.select("job_id", "label",
                     S.dedupe_fields(S.fields_of(F.col("extraction_schema"))).alias("fields"),
                     F.col("pdf_path").alias("doc_id"),
                     F.when(F.col(bad).isNotNull() | F.col("extraction_schema").isNull(),
                            F.lit(ERR_SCHEMA)).alias("error_class"))


def parse_request(request_json) -> tuple:
    """Request string -> (fields, error_class): malformed JSON or a non-object is an error."""
    parsed = S.json_object(request_json)
    fields = S.dedupe_fields(S.fields_of(parsed))
    return fields, F.when(parsed.isNull(), F.lit(ERR_SCHEMA))
