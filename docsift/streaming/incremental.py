"""Incremental extraction with Structured Streaming.

Jobs arrive as files (``readStream`` on parquet / JSON lines / ``binaryFile``
joined to a page table). Every micro-batch runs the same three-level flow as a
batch job (:func:`docsift.operators.extract.extract`) against a persistent cache
bucketed by key (:class:`docsift.sources.cache.KeyedCache`), so a document and request seen in an earlier batch is a cache hit and is
never sent to the fallback again.

Exactly-once effect under replay (a batch re-run after a failure):

* results are written to partition ``batch_id=<n>`` with dynamic partition
  overwrite - a replay replaces the partition instead of duplicating it;
* cache rows lie in a partition of the batch that wrote them. A batch looks up only rows
  of other batches, so its replay computes what it computed before, and it replaces its
  own; only batches before the one at hand, which cannot run again, are compacted;
* fallback answers are kept per batch: a replay reads them instead of asking again;
* the sums of the reports are kept per batch, so a replay counts a batch once.

The stream's own checkpoint, the cache and the results live under ``store``,
which must be a shared folder (by default under ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docsift.operators import stats
from docsift.operators.extract import extract
from docsift.operators.fallback import Fallback
from docsift.session import checkpoint_dir
from docsift.sources.cache import KeyedCache


def new_store(spark: SparkSession, prefix: str = "stream") -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{prefix}-{uuid.uuid4().hex}"


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(target)


def read_cache(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored cache, or None where there is none; a cache that cannot be read is an error."""
    return KeyedCache(spark, path).rows()


def append_cache(new_rows: DataFrame, path: str) -> None:
    """Add cache rows whose key is not in the table yet."""
    KeyedCache(new_rows.sparkSession, path).append(new_rows)


def clear_cache(spark: SparkSession, path: str) -> None:
    """Empty the cache table."""
    KeyedCache(spark, path).clear()


def _answered_once(fallback: Fallback, path: str) -> Fallback:
    """``fallback``, its answers stored under ``path`` and read from there if the batch runs again."""
    def ask(requests: DataFrame) -> DataFrame:
        spark = requests.sparkSession
        if not _exists(spark, f"{path}/_SUCCESS"):
            fallback(requests).select("request_id", "response_json").write.mode("overwrite").parquet(path)
        return spark.read.schema("request_id string, response_json string").parquet(path)

    return ask


def run_batch(batch: DataFrame, batch_id: int, *, store: str, fallback: Fallback | None,
              **options) -> None:
    """One micro-batch; ``options`` as of :func:`docsift.operators.extract.extract`."""
    cache, results_path = KeyedCache(batch.sparkSession, f"{store}/cache"), f"{store}/results"
    if fallback is not None:
        fallback = _answered_once(fallback, f"{store}/answers/batch_id={batch_id}")
    ex = extract(batch, cache=cache.lookup(but_batch=batch_id), fallback=fallback, cache_too=True, **options)
    (ex.results.withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(results_path))
    written = batch.sparkSession.read.schema(ex.results.schema).parquet(f"{results_path}/batch_id={batch_id}")
    stats.partials(stats.per_job(written)).write.mode("overwrite").parquet(f"{store}/report/batch_id={batch_id}")
    cache.append(ex.new_cache, batch_id)        # computed keys are those the cache lacks
    ex.cleanup()
    cache.compact_if_many(before_batch=batch_id)


def extract_stream(jobs: DataFrame, *, store: str, fallback: Fallback | None = None,
                   available_now: bool = True, processing_time: str | None = None, **options) -> StreamingQuery:
    """Start the incremental extraction of a streaming ``jobs(job_id, doc_id, label, fields, text)``.

    ``options`` are those of :func:`docsift.operators.extract.extract` (``rules=``, ``model=``, ...).
    """
    writer = (jobs.writeStream
              .option("checkpointLocation", f"{store}/_checkpoint")
              .foreachBatch(lambda df, bid: run_batch(df, bid, store=store, fallback=fallback, **options)))
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_report(spark: SparkSession, store: str) -> DataFrame:
    """Sums per batch and label (``stats.partials``), kept up batch by batch; ``stats.overall_of`` and
    ``stats.by_type_of`` make the reports of them without reading a result again."""
    return spark.read.parquet(f"{store}/report")


def read_results(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(f"{store}/results")
