"""A ledger of files and their hashes, kept as a table, by which only new files are read.

Listing, comparing and reading all run in tasks:

* ``walk`` lists folders level by level, each folder in a task; a level's folders are the
  rows of the next one. The driver only learns whether a level had folders.
* ``new_files`` of ``files`` (an anti join on path, length and modification time) leaves
  the paths that the ledger lacks.
* ``hash_files`` opens the paths that its rows name, and reads each in chunks, so neither
  the number of files nor a file's size has to fit in memory.

Files are opened with ``pyarrow.fs`` (``file``, ``s3``, ``gs``, ``hdfs``, ...), which has to know
the folder's scheme; other schemes can be read by ``files.scan_files`` (``binaryFile``) or
``stream_files``, a stream whose source log is the ledger.

Names that start with ``_`` or ``.`` are passed over, as Spark does. A file that cannot be
read, or changes between listing and reading, fails the run; the ledger keeps what it was.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from datetime import UTC
from fnmatch import fnmatch

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docsift import schema as S
from docsift.session import Scratch
from docsift.sources.files import new_files

LISTED = "path string, length bigint, modificationTime timestamp"
HASHED = LISTED + ", content_hash string"
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"
CHUNK = 1 << 22


def file_system(path: str):
    """The file system of a path, the path in it, and what to put before such a path to get a full one."""
    from pyarrow import fs

    if local := re.match(r"(?:file:)?/+", path):
        return fs.LocalFileSystem(), "/" + path[local.end():], "file:"
    system, inner = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
    return system, inner, path[:len(path) - len(inner)] if path.endswith(inner) else path.partition("://")[0] + "://"


def _table(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    types = {"string": pa.string(), "bigint": pa.int64(), "timestamp": pa.timestamp("us", "UTC"), "boolean": pa.bool_()}
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(columns, kinds)], list(names))


def _millis(time):
    """To the millisecond, as Spark's own listing gives it."""
    return time.astimezone(UTC).replace(microsecond=time.microsecond // 1000 * 1000)


def walk(spark: SparkSession, *folders: str, glob: str | None = None) -> DataFrame:
    """``LISTED`` for every file under ``folders`` whose name matches ``glob``."""
    from pyarrow import fs as afs

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch["path"].to_pylist():
                system, inner, before = file_system(folder)
                rows = []
                for f in system.get_file_info(afs.FileSelector(inner)):
                    is_folder = f.type == afs.FileType.Directory
                    if f.base_name[:1] not in ("_", ".") and (is_folder or not glob or fnmatch(f.base_name, glob)):
                        rows.append((before + f.path, f.size or 0, f.mtime and _millis(f.mtime), is_folder))
                yield _table(LISTED + ", is_folder boolean", rows)

    scratch = Scratch(spark)
    level, found, depth = spark.createDataFrame([(f,) for f in folders], "path string"), None, 0
    while True:
        entries = scratch.table(level.repartition(spark.sparkContext.defaultParallelism, "path")
                                .mapInArrow(listed, LISTED + ", is_folder boolean"), f"level-{depth}")
        files = entries.filter("NOT is_folder").drop("is_folder")
        found = files if found is None else found.unionByName(files)
        level, depth = entries.filter("is_folder").select("path"), depth + 1
        if level.isEmpty():
            return found


def hash_files(listing: DataFrame) -> DataFrame:
    """``HASHED`` for the files that the rows of ``listing`` (``LISTED``) name, opened by the tasks that hold the rows."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, time in zip(*(batch[c].to_pylist() for c in ("path", "length", "modificationTime"))):
                system, inner, _ = file_system(path)
                digest, n = hashlib.sha256(), 0
                with system.open_input_stream(inner) as f:
                    while chunk := f.read(CHUNK):
                        digest.update(chunk)
                        n += len(chunk)
                if n != length:
                    raise RuntimeError(f"{path} changed while it was read")
                yield _table(HASHED, [(path, length, time, digest.hexdigest())])

    return listing.select("path", "length", "modificationTime").mapInArrow(hashed, HASHED)


class Ledger:
    """A table of ``HASHED`` rows under ``path``, a partition a run."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def rows(self, but_run: int | None = None) -> DataFrame:
        """All rows with their ``run_id``, without those of ``but_run``."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not fs.exists(folder):
            return self.spark.createDataFrame([], HASHED + ", run_id bigint")
        stored = self.spark.read.schema(HASHED + ", run_id bigint").parquet(self.path)
        return stored if but_run is None else stored.filter(F.col("run_id") != but_run)

    def current(self) -> DataFrame:
        """The last row of each path."""
        return self.rows().groupBy("path").agg(F.max_by(F.struct("length", "modificationTime", "content_hash"),
                                                        "run_id").alias("f")).select("path", "f.*")

    def update(self, run_id: int, *folders: str, glob: str | None = None) -> DataFrame:
        """Hashes the files that the ledger lacks and adds them as run ``run_id``; returns those rows.

        A run that is repeated sees the ledger without itself and replaces what it wrote.
        """
        fresh = new_files(walk(self.spark, *folders, glob=glob), self.rows(but_run=run_id))
        out = f"{self.path}/run_id={run_id}"
        hash_files(fresh.repartition(self.spark.sparkContext.defaultParallelism)).write.mode("overwrite").parquet(out)
        return self.spark.read.schema(HASHED).parquet(out)


def stream_files(spark: SparkSession, folder: str, store: str, *, glob: str | None = None,
                 files_per_batch: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Hashes files as they arrive in ``folder`` into the table ``<store>/files`` (``HASHED``).

    The source's log is the ledger: a file that a batch has seen is not read again, also after a restart, and the
    table's own log makes a batch that runs twice count once. Files of length 0 are not read (``binaryFile``).
    """
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    hashed = reader.load(folder).select("path", "length", "modificationTime",
                                        S.content_hash(F.col("content")).alias("content_hash"))
    writer = hashed.writeStream.format("parquet").option("checkpointLocation", f"{store}/_checkpoint")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(f"{store}/files")


def streamed_files(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.schema(HASHED).parquet(f"{store}/files")


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """Writes each row's ``content`` (binary) as file ``name`` under ``folder``, in the tasks; ``path, length`` of each.

    A file appears under its name when it is whole, and a task that runs again writes the same files.
    """
    from pyarrow import fs as afs

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inner, before = file_system(folder)
        system.create_dir(inner, recursive=True)
        for batch in batches:
            for name, content in zip(batch["name"].to_pylist(), batch["content"].to_pylist()):
                path = f"{inner}/{name}"
                with system.open_output_stream(f"{inner}/_{name}.part") as f:
                    f.write(content)
                if system.get_file_info(path).type != afs.FileType.NotFound:
                    system.delete_file(path)
                system.move(f"{inner}/_{name}.part", path)
                yield _table("path string, length bigint", [(before + path, len(content))])

    return Scratch(files.sparkSession).table(files.select("name", "content").mapInArrow(written, "path string, length bigint"),
                                             "written")
