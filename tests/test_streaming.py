"""Incremental extraction: cross-batch cache hits, replay idempotency, stream = batch."""

import json

from pyspark.sql import functions as F

from docsift.operators.extract import extract
from docsift.sources.files import parse_request
from docsift.streaming.incremental import (clear_cache, extract_stream, new_store, read_cache, read_results,
                                           run_batch)

OAB = "carteira_oab"
CARD = "JOANA D'ARC\n123456"
REQ = {"nome": "Nome", "inscricao": "Número"}


def jobs_df(spark, rows):
    data = [(j, d, OAB, json.dumps(REQ), t) for j, d, t in rows]
    df = spark.createDataFrame(data, "job_id long, doc_id long, label string, request string, text string")
    fields, _ = parse_request(F.col("request"))
    return df.select("job_id", "doc_id", "label", fields.alias("fields"), "text")


def test_replayed_batch_adds_nothing(spark):
    store = new_store(spark, "test-replay")
    batch = jobs_df(spark, [(1, 1, CARD), (2, 2, CARD + " two")])
    run_batch(batch, 0, store=store, fallback=None, key_includes_label=False, cache_partial=True)
    run_batch(batch, 0, store=store, fallback=None, key_includes_label=False, cache_partial=True)  # replay
    assert read_cache(spark, f"{store}/cache").count() == 2
    assert read_results(spark, store).count() == 2


def test_later_batch_hits_cache(spark):
    store = new_store(spark, "test-batches")
    run_batch(jobs_df(spark, [(1, 1, CARD)]), 0, store=store, fallback=None,
              key_includes_label=False, cache_partial=True)
    run_batch(jobs_df(spark, [(9, 9, CARD), (10, 10, CARD + "!")]), 1, store=store, fallback=None,
              key_includes_label=False, cache_partial=True)
    res = {r["job_id"]: r for r in read_results(spark, store).collect()}
    assert res[1]["metadata"]["cache_hit"] is False
    assert res[9]["metadata"]["cache_hit"] is True          # same content + request as job 1
    assert {x["field"]: x["value"] for x in res[9]["result"]} == {"nome": "JOANA D'ARC", "inscricao": "123456"}
    assert res[10]["metadata"]["cache_hit"] is False
    assert read_cache(spark, f"{store}/cache").count() == 2
    clear_cache(spark, f"{store}/cache")
    assert read_cache(spark, f"{store}/cache").count() == 0


def test_stream_equals_batch(spark):
    store = new_store(spark, "test-stream")
    jobs = jobs_df(spark, [(i, i, CARD + "\n" + "x" * (i % 4)) for i in range(1, 21)])
    jobs.repartition(3, "job_id").write.parquet(f"{store}/in")
    stream = spark.readStream.schema(jobs.schema).option("maxFilesPerTrigger", 1).parquet(f"{store}/in")
    q = extract_stream(stream, store=f"{store}/out")
    q.awaitTermination()
    streamed = read_results(spark, f"{store}/out")
    assert streamed.select("batch_id").distinct().count() == 3
    batch = extract(jobs).results
    key = ["job_id"]
    a = sorted((r["job_id"], str(r["result"])) for r in streamed.select(*key, "result").collect())
    b = sorted((r["job_id"], str(r["result"])) for r in batch.select(*key, "result").collect())
    assert a == b
