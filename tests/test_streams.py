"""Reports kept batch by batch, first arrivals within a watermark, the sink in manifest order, key counts."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from docsift.operators import stats
from docsift.operators.extract import extract
from docsift.operators.keys import distinct_keys
from docsift.sources.files import parse_request
from docsift.sources.sinks import read_results_in_order, write_results_in_order
from docsift.streaming.dedup import first_arrivals
from docsift.streaming.incremental import new_store, read_report, read_results, run_batch


def jobs(spark, ids):
    rows = [(i, i, ["carteira_oab", "tela_sistema", None][i % 3], '{"nome": "n", "x": "y"}' if i % 4 else "{bad",
             f"JOANA {'A' * (i % 6 + 1)}" if i % 5 else None) for i in ids]
    df = spark.createDataFrame(rows, "job_id long, doc_id long, label string, request string, text string")
    fields, error = parse_request(F.col("request"))
    return df.select("job_id", "doc_id", "label", fields.alias("fields"), "text", error.alias("error_class"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_report_of_batches_equals_report_of_all(spark):
    store = new_store(spark, "test-report")
    for batch in (0, 1, 1, 2):                                     # batch 1 runs twice
        run_batch(jobs(spark, range(batch * 15, batch * 15 + 15)), batch, store=store, fallback=None)
    everything = stats.per_job(read_results(spark, store).drop("batch_id"))
    assert rows(stats.overall_of(read_report(spark, store))) == rows(stats.overall(everything))
    assert rows(stats.by_type_of(read_report(spark, store))) == rows(stats.by_type(everything))
    assert stats.overall_of(read_report(spark, store)).first()["total_files"] == 45


def test_first_arrivals_and_late_rows(spark):
    store, day = new_store(spark, "test-arrivals"), dt.datetime(2024, 1, 1)
    batches = [[("a", 0), ("b", 1), ("a", 2)],                     # a second time within the batch
               [("a", 5), ("c", 6)],                               # and in the next one
               [("d", 100)],                                       # the watermark goes to 90,
               [("g", 101)],                                       # and holds for rows from the batch after the next
               [("e", 50), ("f", 95), ("d", 96)],                  # e comes too late; d again
               [("a", 103)]]                                       # long after: its state is gone, it counts as new
    for batch in batches:
        (spark.createDataFrame([(k, day + dt.timedelta(minutes=m)) for k, m in batch], "key string, at timestamp")
         .coalesce(1).write.mode("append").parquet(f"{store}/in"))
    stream = spark.readStream.schema("key string, at timestamp").option("maxFilesPerTrigger", 1).parquet(f"{store}/in")
    query = (first_arrivals(stream, ["key"], "at", "10 minutes").writeStream.format("parquet")
             .option("checkpointLocation", f"{store}/_checkpoint").trigger(availableNow=True).start(f"{store}/out"))
    query.awaitTermination()
    got = spark.read.schema("key string, at timestamp").parquet(f"{store}/out").select(
        "key", ((F.unix_seconds("at") - F.unix_seconds(F.lit(day))) / 60).cast("int"))
    assert sorted(k for k, _ in rows(got)) == ["a", "a", "b", "c", "d", "f", "g"]
    assert [m for k, m in rows(got) if k == "a"][-1] == 103


def test_results_lie_in_manifest_order(spark):
    path = new_store(spark, "test-ordered")
    results = extract(jobs(spark, [7, 3, 99, 12, 5, 40, 41, 1000, 2, 8])).results
    write_results_in_order(results, path, files=4)
    folder = path.removeprefix("file:")
    parts = sorted(p for p in os.listdir(folder) if p.endswith(".json"))
    assert len(parts) > 1
    ids = [json.loads(line)["job_id"] for p in parts for line in open(os.path.join(folder, p), encoding="utf-8")]
    assert ids == sorted(ids) and len(ids) == 10
    spark.conf.set("spark.sql.files.maxPartitionBytes", 300)       # many splits a file
    try:
        placed = {r["position"]: json.loads(r["line"])["job_id"] for r in read_results_in_order(spark, path).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert placed == {i + 1: j for i, j in enumerate(ids)}


def test_distinct_keys_equal_those_formed(spark):
    contents = spark.createDataFrame([("x", "a"), ("x", "b"), ("x", "a"), ("y", "a"), ("z", "q")], "label string, content_hash string")
    requests = spark.createDataFrame([("x", "1"), ("x", "2"), ("x", "2"), ("y", "1"), ("w", "9")], "label string, schema_hash string")
    formed = contents.join(requests, "label").groupBy("label").agg(F.countDistinct("content_hash", "schema_hash").alias("n"))
    counted = distinct_keys(contents, requests, "label")
    assert "Cartesian" not in counted._jdf.queryExecution().toString()
    assert rows(counted.select("label", "n_keys")) == rows(formed) == [("x", 4), ("y", 1)]
