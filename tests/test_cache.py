"""The cache bucketed by key: lookups read only what they need, replays and compaction keep the rows."""

import re

from pyspark.sql import functions as F

from docsift import schema as S
from docsift.operators.extract import extract
from docsift.sources import cache as C
from docsift.sources.files import parse_request
from docsift.streaming.incremental import new_store, run_batch


def cache_rows(spark, ids, tag):
    key = F.sha2(F.col("id").cast("string"), 256)
    result = F.array(F.struct(F.lit("f").alias("field"), F.lit(tag).alias("value"), F.lit("s").alias("source"),
                              F.lit(None).cast("string").alias("raw")))
    return spark.range(*ids).select(key.alias("cache_key"), F.lit("c").alias("content_hash"), F.lit(tag).alias("schema_hash"),
                                    result.cast(S.CACHE["result"].dataType).alias("result"),
                                    F.current_timestamp().alias("created_at"))


def tags(cache, but_batch=None):
    return {r[0]: r[1] for r in cache.rows(but_batch).groupBy("schema_hash").count().collect()}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_reads_only_the_buckets_of_few_keys(spark, tmp_path):
    cache = C.KeyedCache(spark, str(tmp_path / "cache"), buckets=16)
    assert cache.rows() is None and cache.rows_for(spark.range(1)) is None
    cache.append(cache_rows(spark, (0, 2000), "a"), batch_id=0)
    wanted = cache_rows(spark, (5, 7), "x").select("cache_key")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")     # shows how many are read
    try:
        found = cache.rows_for(wanted)
        plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    chosen = re.search(r"SelectedBucketsCount: (\d+) out of 16", plan)
    assert chosen and int(chosen[1]) <= 2, plan
    assert wanted.join(found, "cache_key").count() == 2
    assert cache.rows_for(cache_rows(spark, (9000, 9002), "x")).count() == 0


def test_lookup_of_many_keys_joins_bucket_by_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "PRUNE_KEYS", 10)
    cache = C.KeyedCache(spark, str(tmp_path / "cache"), buckets=6)
    cache.append(cache_rows(spark, (0, 500), "a"), batch_id=0)
    wanted = cache_rows(spark, (400, 600), "x").select("cache_key")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = wanted.join(cache.rows_for(wanted), "cache_key", "left")
        plan = plan_of(joined)
        assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(cache_key" in plan
        assert re.search(r"hashpartitioning\(cache_key#\d+, 6\)", plan) and "Bucketed: true" in plan
        assert joined.filter("schema_hash = 'a'").count() == 100 and joined.count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_replay_compaction_and_an_interrupted_one(spark, tmp_path):
    cache = C.KeyedCache(spark, str(tmp_path / "cache"), buckets=4)
    for batch in range(3):
        cache.append(cache_rows(spark, (batch * 100, batch * 100 + 100), f"b{batch}"), batch_id=batch)
    cache.append(cache_rows(spark, (200, 300), "again"), batch_id=2)              # a replay
    assert tags(cache) == {"b0": 100, "b1": 100, "again": 100} and cache.batches() == 3
    before = cache.rows()
    cache.compact(before_batch=2)
    assert tags(cache) == {"b0": 100, "b1": 100, "again": 100} and cache.batches() == 2
    assert before.count() == 300                                                  # a reader of the version before
    assert tags(cache, but_batch=2) == {"b0": 100, "b1": 100}                     # the batch can still run again
    cache._write(cache.rows().limit(5).withColumn("batch_id", F.lit(7).cast("long")), cache._begin())
    assert tags(cache) == {"b0": 100, "b1": 100, "again": 100}                    # never marked as complete
    other = C.KeyedCache(spark, cache.path, buckets=9)                            # another number of buckets from now on
    other.append(cache_rows(spark, (250, 350), "late"))                           # stored keys stay as they are
    assert tags(other) == {"b0": 100, "b1": 100, "again": 100, "late": 50}
    assert other.versions()[-1].buckets == 9 and tags(cache) == tags(other)
    other.clear()
    assert cache.rows().count() == 0


def test_stream_compacts_and_still_hits(spark, monkeypatch):
    monkeypatch.setattr(C, "MANY_BATCHES", 2)
    store = new_store(spark, "test-compact")
    df = spark.createDataFrame([(i, i, "carteira_oab", '{"nome": "n"}', f"JOANA {'A' * (i % 7 + 1)}") for i in range(20)],
                               "job_id long, doc_id long, label string, request string, text string")
    jobs = df.select("job_id", "doc_id", "label", parse_request(F.col("request"))[0].alias("fields"), "text")
    for batch in range(5):
        run_batch(jobs.filter(F.col("job_id") < 4 * batch + 4), batch, store=store, fallback=None)
    cache = C.KeyedCache(spark, f"{store}/cache")
    assert cache.rows().count() == 7 and cache.batches() <= 3 and len(cache.versions()) == 2
    again = extract(jobs, cache=cache.lookup())
    assert again.results.filter(~F.col("metadata.cache_hit")).count() == 0
