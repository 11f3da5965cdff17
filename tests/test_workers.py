"""The fallback run by workers: retries, pace, a log that outlives a lost task."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from docsift.operators.extract import extract, result_long
from docsift.operators import workers
from docsift.operators.workers import answered, by_workers
from docsift.sources.files import parse_request
from docsift.streaming.incremental import new_store


def requests(spark, n):
    df = spark.range(n).withColumn("request_id", F.concat(F.lit("r"), "id"))
    return df.select("request_id", F.col("id").alias("doc_id"), F.lit("l").alias("label"), F.lit("p").alias("prompt"),
                     F.struct(F.lit("m").alias("model")).alias("request"))


def client(folder, fails=lambda doc_id: 0):
    """Notes each call in a file of ``folder``; the first ``fails(doc_id)`` calls of a request raise."""
    def answer(request):
        path = os.path.join(folder, request["request_id"])
        with open(path, "a") as f:
            f.write("x")
        if os.path.getsize(path) <= fails(request["doc_id"]):
            raise TimeoutError
        return json.dumps({"doc": request["doc_id"], "model": json.loads(request["request"])["model"]})

    return answer


def calls(folder):
    return {n: os.path.getsize(os.path.join(folder, n)) for n in os.listdir(folder)}


def test_each_request_is_answered_once(spark, tmp_path):
    log = new_store(spark, "test-answers")
    ask = by_workers(client(str(tmp_path), lambda d: d % 5), log, clients=3, attempts=3, wait=0.001, log_every=4)
    got = {r["request_id"]: (r["response_json"], r["attempts"]) for r in ask(requests(spark, 40)).collect()}
    assert got == {f"r{d}": (json.dumps({"doc": d, "model": "m"}) if d % 5 < 3 else None, min(d % 5 + 1, 3)) for d in range(40)}
    assert calls(tmp_path) == {f"r{d}": min(d % 5 + 1, 3) for d in range(40)}
    again = {r["request_id"]: r["response_json"] for r in ask(requests(spark, 45)).collect()}      # the same log
    made = calls(tmp_path)
    assert all(made[f"r{d}"] == d % 5 + 1 for d in range(45) if d % 5 < 3)         # nothing answered is asked again
    assert {r for r, v in again.items() if v is None} == {"r43", "r44"}            # what failed is, and is answered now


def test_a_waiting_request_holds_up_no_other(spark, tmp_path):
    """120 requests that fail once: the waits of half a second run side by side, 60 s a client one after another."""
    ask = by_workers(client(str(tmp_path), lambda d: 1), new_store(spark, "test-answers"), clients=1, attempts=2, wait=0.5)
    start = time.monotonic()
    got = [r["attempts"] for r in ask(requests(spark, 120)).collect()]
    assert got == [2] * 120 and time.monotonic() - start < 30
    assert set(calls(tmp_path).values()) == {2}


def test_few_requests_wait_at_a_time(monkeypatch):
    """With as many waiting as a client holds, it sits out the next wait before it asks another request."""
    monkeypatch.setattr(workers, "WAITING", 3)
    seen, most, open_now = {}, [0], set()

    def answer(request):
        key = request["request_id"]
        seen[key] = seen.get(key, 0) + 1
        open_now.add(key)
        most[0] = max(most[0], len(open_now))
        if seen[key] < 2:
            raise TimeoutError
        open_now.remove(key)
        return "{}"

    rows = (("f", {"request_id": str(i)}) for i in range(20))
    out = list(workers._asked(answer, rows, 2, 0.01, lambda: None))
    assert sorted(out) == sorted(("f", (str(i), "{}", 2)) for i in range(20))
    assert most[0] <= 4 and not open_now


def test_requests_of_one_id_are_asked_one_after_another():
    made = []

    def answer(request):
        made.append(request["request_id"] + request["label"])
        if made.count(made[-1]) < 3:
            raise TimeoutError
        return "{}"

    rows = [("f", {"request_id": k, "label": label}) for label in "xyz" for k in "ab"]
    assert sorted(workers._asked(answer, rows, 3, 0.001, lambda: None)) == [
        ("f", ("a", "{}", 3))] * 3 + [("f", ("b", "{}", 3))] * 3
    for k in "ab":
        assert [m for m in made if m[0] == k] == [k + label for label in "xyz" for _ in range(3)]


def test_a_lost_task_loses_no_answer(spark, tmp_path):
    """A worker that dies in the middle: the next run asks only what the log lacks."""
    log = new_store(spark, "test-answers")
    plain = client(str(tmp_path))

    def dies(request):
        if request["doc_id"] == 17:
            os._exit(1)
        return plain(request)

    with pytest.raises(Exception):
        by_workers(dies, log, clients=1, log_every=1)(requests(spark, 30)).collect()
    before = answered(spark, log).count()
    assert 0 < before < 30
    assert by_workers(plain, log, clients=1, log_every=1)(requests(spark, 30)).count() == 30
    assert set(calls(tmp_path).values()) == {1}


def test_the_pace_is_kept(spark, tmp_path):
    start = time.monotonic()
    ask = by_workers(client(str(tmp_path)), new_store(spark, "test-answers"), clients=2, calls_per_second=20)
    assert ask(requests(spark, 30)).count() == 30
    assert time.monotonic() - start > 30 / 20 / 2                                  # one client alone has 10 a second


def test_extraction_with_workers(spark, tmp_path):
    df = spark.createDataFrame([(i, i, "carteira_oab", '{"nome": "n", "apelido": "a"}', f"JOANA {'AB'[i % 2]}") for i in range(6)],
                               "job_id long, doc_id long, label string, request string, text string")
    jobs = df.select("job_id", "doc_id", "label", parse_request(F.col("request"))[0].alias("fields"), "text")

    def answer(request):
        if request["prompt"].count("JOANA B"):
            raise ConnectionError
        return '{"apelido": "Jo"}'

    run = extract(jobs, fallback=by_workers(answer, new_store(spark, "test-answers"), clients=2, wait=0.001))
    got = {(r["job_id"], r["field"]): r["value"] for r in result_long(run.results).collect()}
    assert got == {(i, f): v for i in range(6) for f, v in (
        ("nome", f"JOANA {'AB'[i % 2]}"), ("apelido", None if i % 2 else "Jo"))}
    errors = {r["job_id"]: r["metadata"]["llm_error"] for r in run.results.filter("NOT metadata.cache_hit").collect()}
    assert errors == {0: None, 1: "fallback returned no response"}
