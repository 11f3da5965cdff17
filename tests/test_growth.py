"""What is worked out for every job, and what only for the jobs or requests that need it."""

import json

from pyspark.sql import functions as F

from docsift import catalog
from docsift.operators import extract as X
from docsift.operators.engine import attach_plans, plan_table
from docsift.session import materialize
from sf_paths import SF_SMALL as SMOKE

FIELDS = "array<struct<ord:int,field:string,description:string>>"


def optimised(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def fixture_jobs(spark):
    return X.prepare_jobs(catalog.fixture_docs(spark, SMOKE, "both"), request="request", dealt=True)


def own_jobs(spark):
    """Requests in two orders, a description with JSON in two orders, one without any field, null fields, null text, null label."""
    a, b = '{"ord":0,"field":"nome","description":"x"}', '{"ord":1,"field":"cpf","description":null}'
    rows = [(1, "oab", f"[{a},{b}]", "MARIA"), (2, "oab", f"[{b},{a}]", "MARIA"), (3, None, f"[{a},{b}]", "JOSE"),
            (4, "oab", None, "MARIA"), (5, "sistema", f"[{a}]", None), (6, "oab", "[]", ""), (6, "oab", "[]", ""), (None, "oab", f"[{a}]", "ANA"),
            (7, "x", json.dumps([{"ord": 0, "field": "f", "description": '{"b":1,"a":2}'}]), "t"),
            (8, "y", json.dumps([{"ord": 0, "field": "f", "description": '{"a":2,"b":1}'}]), "t")]
    df = spark.createDataFrame(rows, "job_id long, label string, f string, text string")
    return df.select("job_id", F.col("job_id").alias("doc_id"), "label", F.from_json("f", FIELDS).alias("fields"), "text")


def test_request_hash_comes_with_the_plan(spark):
    """hashed once for each distinct request, with the same keys and errors as hashed for each job."""
    jobs = own_jobs(spark)
    plans = plan_table(jobs, lambda df: materialize(df, "plans"))
    by_plan, by_job = X.scan(jobs, plans=plans), X.scan(jobs)
    assert "sort_array" in optimised(by_job) and "sort_array" not in optimised(by_plan)
    assert "fields" not in by_plan.columns
    assert sorted(map(str, by_plan.collect())) == sorted(map(str, by_job.collect()))
    hashes = {r["job_id"]: r["schema_hash"] for r in by_plan.collect()}
    assert hashes[1] == hashes[2] == hashes[3] and hashes[7] == hashes[8] and hashes[4] is None and hashes[5] is None


def test_texts_are_formed_for_the_jobs_that_compute(spark, monkeypatch):
    """the jobs are picked below the projection that puts the texts together, by a broadcast and by a shuffle."""
    jobs = fixture_jobs(spark)
    scanned = materialize(X.scan(jobs), "scan")
    ids = materialize(scanned.filter(F.pmod("job_id", F.lit(5)) < 2).select("job_id"), "ids")
    want = sorted(r[0] for r in ids.collect())
    for most in (1_000_000, 0):
        monkeypatch.setattr(X, "BROADCAST_IDS", most)
        todo = X._computing(jobs, scanned, ids)
        lines = optimised(todo).splitlines()
        semi = [i for i, line in enumerate(lines) if "Join LeftSemi" in line]
        assert len(semi) == 2                                              # one a table
        assert not any("CONSELHO" in line or "MARIA" in line or "Cidade" in line for line in lines[semi[-1]:])
        assert sorted(r["job_id"] for r in todo.select("job_id").collect()) == want


def test_requests_are_not_copied_to_meet_their_plans(spark):
    """the plans have the type of the requests, so no job's request is cast; every request meets its plan."""
    for jobs in (fixture_jobs(spark), own_jobs(spark)):
        plans = plan_table(jobs, lambda df: materialize(df, "plans"))
        out = attach_plans(jobs, plans)
        assert "cast(fields" not in optimised(out)
        assert out.filter(F.col("fields").isNotNull() & F.col("_plan").isNull()).isEmpty()
        assert out.count() == jobs.count()


def test_json_of_plain_results_is_written_in_one_go(spark):
    """the same text as before, also where a name stands twice, a value came as JSON, or an entry is null."""
    odd = 'a"b\\c\n\t\x01é 😀/'
    rows = [(1, [("nome", odd, None), ("x" + odd, None, None)]), (2, []), (3, None),
            (4, [("a", "1", None), ("a", "2", None)]), (5, [("a", "1", "1.50"), ("b", None, None), ("c", "s", None)]),
            (6, [("a", "1", None), None]), (7, [("z", "", None), ("a", "v", None)])]
    df = spark.createDataFrame(rows, "i int, result array<struct<field:string,value:string,raw:string>>")
    out = df.select("i", X.result_json(F.col("result")).alias("j"))
    assert "map_from_arrays" in optimised(out.filter("i > 0"))
    got = {r["i"]: r["j"] for r in out.collect()}
    text = lambda v: json.dumps(v, ensure_ascii=False, separators=(",", ":"))
    for i, result in rows:
        if i in (1, 2, 7):
            assert json.loads(got[i]) == {f: v for f, v, _ in result} and list(json.loads(got[i])) == [f for f, _, _ in result]
    assert got[1].startswith('{"nome":"a\\"b\\\\c\\n\\t\\u0001é') and " " not in got[1]
    assert (got[2], got[3], got[4], got[5], got[6]) == ("{}", None, '{"a":"1","a":"2"}', '{"a":1.50,"b":null,"c":"s"}', '{"a":"1",null:null}')
    assert got[7] == text({"z": "", "a": "v"})
