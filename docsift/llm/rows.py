"""Dropping decided rows from a table without moving its texts where that can be proven cheap.

Columns whose names start with ``__docsift_`` are reserved: a table that has one is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.session import materialize

BROADCAST_ROWS = 1_000_000      # of one long each
RESERVED = "__docsift_"
ROW = "__docsift_row"                 # the column that ``numbered`` adds
FILE_ROWS = 33                  # bits of a row's place in its file


def _is_parquet(docs: DataFrame) -> bool:
    """Whether ``docs`` is Parquet files as they are, with nothing done to their rows."""
    plan = docs._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return False
    relation = plan.relation()
    return (relation.getClass().getSimpleName() == "HadoopFsRelation"
            and relation.fileFormat().getClass().getSimpleName() == "ParquetFileFormat")


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` plus a long ``ROW``, the same for a row in every reading, however Spark splits the files.

    For Parquet files it is made of the file's place among the sorted names and the row's place in the file, so
    no text moves. Anything else is written to a table once, numbers included.
    """
    if taken := [c for c in docs.columns if c.lower().startswith(RESERVED)]:
        raise ValueError(f"reserved column names: {taken}")
    if not _is_parquet(docs):
        return materialize(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    names = docs.select(F.col("_metadata.file_path")).distinct().collect()      # the driver lists the files anyway
    files = docs.sparkSession.createDataFrame([(n, i) for i, (n,) in enumerate(sorted(names))], f"{RESERVED}name string, {RESERVED}file long")
    lost = F.raise_error(F.lit("a file that was not listed")).cast("long")
    row = F.shiftleft(F.coalesce(f"{RESERVED}file", lost), FILE_ROWS) + F.col(f"{RESERVED}at")
    return (docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("_metadata.file_path").alias(f"{RESERVED}name"),
                        F.col("_metadata.row_index").alias(f"{RESERVED}at"))
            .join(F.broadcast(files), f"{RESERVED}name", "left")
            .select(*[F.col(f"`{c}`") for c in docs.columns], row.alias(ROW)))


def row_of(docs: DataFrame):
    """The number of a row: that of ``numbered`` documents, else one that holds for this reading only."""
    return F.col(ROW) if ROW in docs.columns else F.monotonically_increasing_id()


def without_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs``, as ``numbered`` gives them, without the rows whose number is in ``dropped(row)``; all columns but it.

    The dropped numbers are counted: up to ``BROADCAST_ROWS`` they go to the rows, beyond that it is a
    shuffle join.
    """
    dropped = materialize(dropped.select(F.col("row").alias(ROW)), "dropped")
    if dropped.count() <= BROADCAST_ROWS:
        dropped = F.broadcast(dropped)
    return docs.join(dropped, ROW, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns if c != ROW])
