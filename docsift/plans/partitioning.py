"""Partitioning helpers.

Regex extraction is CPU work per row, so it needs every core busy. A large
input has many files and row groups and already splits into enough tasks; a
small input stored as one row group reads as a single task. ``spread`` fixes
only that case: where the input files cannot give every core a split, rows are
redistributed round-robin (one exchange). It looks at the file listing alone and
runs no part of the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def _splits(df: DataFrame, enough: int) -> int:
    """Splits that the input files allow; counting stops at ``enough``. 0 without files."""
    spark = df.sparkSession
    split_bytes = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    hadoop = spark._jsparkSession.sessionState().newHadoopConf()
    n = 0
    for name in df.inputFiles()[:enough]:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        n += max(1, -(-path.getFileSystem(hadoop).getFileStatus(path).getLen() // split_bytes))
    return n


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    if df.isStreaming:
        return df
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if not 0 < _splits(df, target) < target:
        return df
    return df.repartition(target)
