"""What lies on disk while results are formed and written in order, and that less of it gives the same rows."""

import gzip
import json
import os
import time

from pyspark.sql import functions as F

from docsift import catalog
from docsift import schema as S
from docsift.operators.extract import extract
from docsift.operators.skew import salted_join
from docsift.session import Scratch, checkpoint_dir
from docsift.sources.files import parse_request
from docsift.sources.sinks import read_results_in_order, write_results_in_order
from docsift.streaming.incremental import new_store
from sf_paths import SF_SMALL as SMOKE

CARD = "JOANA {}\n123456\nTelefone Profissional\nSITUAÇÃO REGULAR"


def jobs(spark, ids):
    rows = [(i, j, ["carteira_oab", "tela_sistema", None][j % 3],
             '{"nome": "n", "telefone_profissional": "t", "inscricao": "i"}' if j % 4 else "{bad",
             CARD.format("AB"[j % 2] * (j % 5 + 1)) if j % 7 else None) for j, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "job_id long, doc_id long, label string, request string, text string")
    fields, error = parse_request(F.col("request"))
    return df.select("job_id", "doc_id", "label", fields.alias("fields"), "text", error.alias("error_class"))


def rows(df):
    return sorted(map(repr, df.collect()))


def folder(spark):
    return checkpoint_dir(spark).removeprefix("file:")


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while blocks.hasNext():
        name = blocks.next().getName()
        if name.startswith("shuffle_"):
            names.add(name)
    return names


def test_shuffle_files_go_with_their_table(spark):
    before = shuffle_files(spark)
    df = spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count()
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    table = Scratch(spark, lean=True).table(df, "counts")
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left                                                     # and no garbage was collected for it
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == setting
    assert rows(table) == rows(df)


def test_ordered_results_leave_no_extraction_on_disk(spark):
    """Once the results are stored the tables of the extraction go, and the lines lie compressed."""
    before = set(os.listdir(folder(spark)))
    lines = catalog.results_in_order(spark, SMOKE)
    new = [d for d in os.listdir(folder(spark)) if d not in before]
    assert sorted(t for d in new if d.startswith("docsift-") for t in os.listdir(os.path.join(folder(spark), d))) == ["pieces"]
    [ordered] = [os.path.join(folder(spark), d) for d in new if d.startswith("ordered-")]
    parts = sorted(p for p in os.listdir(ordered) if p.startswith("part-"))
    assert parts and all(p.endswith(".json.gz") for p in parts)
    text = [json.loads(x) for p in parts for x in gzip.open(os.path.join(ordered, p), "rt", encoding="utf-8")]
    assert [(i + 1, r["job_id"], r["result_json"]) for i, r in enumerate(text)] == [
        tuple(r) for r in lines.orderBy("position").collect()]


def test_compressed_lines_keep_their_places(spark):
    ids = [7, 3, 99, 12, 5, 40, 41, 1000, 2, 8, 17, 18]
    results = extract(jobs(spark, ids)).results
    path, calls = new_store(spark, "test-ordered"), []
    write_results_in_order(results, path, files=4, compression="gzip",
                           stored=lambda: calls.append(os.path.exists(path.removeprefix("file:"))))
    assert calls == [False]                                             # called once, before the lines are written
    spark.conf.set("spark.sql.files.maxPartitionBytes", 300)
    try:
        placed = {r["position"]: json.loads(r["line"])["job_id"] for r in read_results_in_order(spark, path).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert placed == {i + 1: j for i, j in enumerate(sorted(ids))}


def test_staged_extraction_gives_the_same(spark):
    """Also with ids that come twice or are null, other contents under one id, cached and repeated keys, hot keys."""
    df = jobs(spark, [1, 2, 3, 4, 5, 6, 6, 8, 8, None, None, 12, 13, 14, 15, 1, 17, 18, 19, 20] * 2)
    cache = extract(jobs(spark, range(4)), key_includes_label=True).new_cache.localCheckpoint()
    for options in ({}, {"fallback": catalog.fixture_fallback, "hot_rows": 3, "key_includes_label": True,
                         "cache": lambda keys: cache.join(keys.select("cache_key"), "cache_key", "left_semi")}):
        plain, staged = extract(df, **options), extract(df, staged=True, **options)
        assert rows(plain.results) == rows(staged.results) and plain.results.count() >= 40
        assert rows(plain.requests) == rows(staged.requests)
        assert rows(plain.new_cache.drop("created_at")) == rows(staged.new_cache.drop("created_at"))
        assert not os.path.exists(os.path.join(staged.scratch.path.removeprefix("file:"), "keys"))


def test_keys_are_stored_as_bytes(spark):
    run = extract(jobs(spark, range(20)))
    scanned = spark.read.parquet(f"{run.scratch.path}/scan")
    assert "content_hash" not in scanned.columns and dict(scanned.dtypes)["cache_key"] == "binary"
    assert {r[0] for r in scanned.select(F.octet_length("cache_key")).collect()} == {None, 64}
    keys = [S.cache_key(F.sha2("t", 256), F.sha2("r", 256), lab).alias("k") for lab in (None, F.col("l"))]
    made = spark.createDataFrame([("a", "b", "c"), ("d", "e", None)], "t string, r string, l string")
    for key in keys:
        df = made.select(key)
        for formed in (True, False):
            assert rows(df.select(S.unpacked_key(S.packed_key(F.col("k"), formed=formed)).alias("k"))) == rows(df)
    other = [("x",), ("A" * 64,), ("a" * 64 + "\n",), ("a" * 65,), ("a" * 64 + ":",), (None,), ("",)]
    packed = spark.createDataFrame(other, "k string").select(S.packed_key(F.col("k")).alias("k"))
    assert packed.filter(F.col("k").isNotNull()).isEmpty()
    assert packed.filter(S.unpacked_key(F.col("k")).isNotNull()).isEmpty()


def test_a_repeated_count_does_not_repeat_rows(spark):
    big = spark.range(12).select("id", F.lit("k").alias("key"))
    small = spark.createDataFrame([("k", 12, "v")], "key string, n long, v string")
    counts = small.select("key", "n").unionAll(small.select("key", "n"))
    joined = salted_join(big, small, "key", count_col="n", order_col="id", hot_rows=3, counts=counts)
    assert [r["id"] for r in joined.orderBy("id").collect()] == list(range(12))
