"""Sinks: result JSON (also in manifest order), report tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsift.operators.extract import result_json
from docsift.session import Scratch, shuffles_given_up
from docsift.sources.files import placed_pieces


def result_records(results: DataFrame) -> DataFrame:
    """One JSON-ready row per job: ids, label, the result object as JSON text, error."""
    return results.select("job_id", "doc_id", "label",
                          result_json(F.col("result")).alias("result_json"),
                          "metadata", "error_class", "error_message")


def write_results_json(results: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, one object per job; result keys in request order, nulls and accents kept."""
    result_records(results).write.mode(mode).json(path)


def write_results_in_order(results: DataFrame, path: str, files: int | None = None, mode: str = "overwrite", *,
                           compression: str | None = None, stored: Callable[[], None] | None = None) -> None:
    """JSON lines in manifest order: the files, in the order of their names, and the lines in each rise by ``job_id``.

    The jobs are dealt to files by ranges of their ids, so no task sorts or holds more than its range. ``compression``:
    of the files, e.g. ``gzip`` (each is then read by one task). ``stored`` is called once ``results`` is not read
    any more, before the lines are written, e.g. to delete the tables behind it.
    """
    spark = results.sparkSession
    n, scratch = files or int(spark.conf.get("spark.sql.shuffle.partitions")), Scratch(spark, lean=True)
    records = scratch.table(result_records(results), "records")     # the ranges are found by a reading of their own
    if stored:
        stored()
    with shuffles_given_up(spark):
        (records.repartitionByRange(n, "job_id").sortWithinPartitions("job_id")
         .write.mode(mode).json(path, compression=compression))
    scratch.remove()


def read_results_in_order(spark: SparkSession, path: str) -> DataFrame:
    """``position`` (from 1) and ``line`` of the lines under ``path``, read by many tasks in the order they were written."""
    lines = placed_pieces(spark, path, "\n")
    splits = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.orderBy("file", "block")) - F.col("n")      # one row a split
    splits = splits.select("file", "block", (before - F.col("first") + 1).alias("shift"))
    # a split is read by one task, so the ids of its lines follow on from each other and no line is moved
    return lines.join(F.broadcast(splits), ["file", "block"]).select(
        (F.col("at") + F.col("shift")).alias("position"), F.col("piece").alias("line"))


def write_report(tables: dict[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    """Per-job, overall and by-type statistics as parquet tables under ``path``."""
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{path}/{name}")
