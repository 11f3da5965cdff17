"""Three-level extraction: cache, fallback merge, metadata variants, statistics."""

import json

import pytest
from pyspark.sql import functions as F

from docsift.operators import stats
from docsift.operators.extract import extract, result_json
from docsift.sources.files import parse_request

OAB = "carteira_oab"
CARD = "JOANA D'ARC\n123456\nTelefone Profissional\nSITUAÇÃO REGULAR"
REQ_FULL = {"nome": "Nome", "inscricao": "Número", "telefone_profissional": "Telefone"}
REQ_FOUND = {"nome": "Nome", "inscricao": "Número"}


def jobs_df(spark, rows):
    """rows: (job_id, doc_id, label, request dict, text or None)"""
    data = [(j, d, lab, json.dumps(r, ensure_ascii=False), t) for j, d, lab, r, t in rows]
    df = spark.createDataFrame(data, "job_id long, doc_id long, label string, request string, text string")
    fields, _ = parse_request(F.col("request"))
    return df.select("job_id", "doc_id", "label", fields.alias("fields"), "text")


def answers(mapping):
    """Fallback that answers from a {doc_id: response_json} dict, through a join."""
    def fb(requests):
        spark = requests.sparkSession
        table = spark.createDataFrame(list(mapping.items()), "doc_id long, response_json string")
        return requests.join(table, "doc_id", "left").select("request_id", "response_json")
    return fb


def by_job(ex):
    return {r["job_id"]: r for r in ex.results.collect()}


def values(row):
    return {r["field"]: r["value"] for r in row["result"]}


def test_all_found_by_rules(spark):
    ex = extract(jobs_df(spark, [(1, 1, OAB, REQ_FOUND, CARD)]))
    r = by_job(ex)[1]
    assert values(r) == {"nome": "JOANA D'ARC", "inscricao": "123456"}
    m = r["metadata"]
    assert (m["cache_hit"], m["heuristics_used"], m["llm_used"]) == (False, True, False)
    assert m["found_by_heuristics"] == ["nome", "inscricao"]
    assert m["found_by_llm"] is None and m["llm_error"] is None
    assert ex.requests.count() == 0


def test_fallback_fills_only_missing_fields(spark):
    resp = {5: '{"telefone_profissional": "(11) 1234-5678", "nome": "OTHER", "extra": 1}'}
    ex = extract(jobs_df(spark, [(1, 5, OAB, REQ_FULL, CARD)]), fallback=answers(resp))
    r = by_job(ex)[1]
    assert values(r) == {"nome": "JOANA D'ARC", "inscricao": "123456", "telefone_profissional": "(11) 1234-5678"}
    assert [x["source"] for x in r["result"]] == ["label_rules", "label_rules", "fallback"]
    m = r["metadata"]
    assert (m["heuristics_used"], m["llm_used"], m["found_by_llm"]) == (True, True, ["telefone_profissional"])
    req = ex.requests.collect()
    assert len(req) == 1 and [f["field"] for f in req[0]["missing"]] == ["telefone_profissional"]
    assert '"telefone_profissional": "Telefone"' in req[0]["prompt"]
    assert req[0]["request"]["model"] and len(req[0]["request"]["messages"]) == 2


def test_fallback_absent_key_is_null_but_counted(spark):
    ex = extract(jobs_df(spark, [(1, 5, OAB, REQ_FULL, CARD)]), fallback=answers({5: '{"other": "x"}'}))
    r = by_job(ex)[1]
    assert values(r)["telefone_profissional"] is None
    assert r["metadata"]["found_by_llm"] == ["telefone_profissional"]   # asked, even if null
    s = stats.per_job(ex.results).collect()[0]
    assert (s["heuristics"], s["llm"], s["found"], s["llm_found"]) == (2, 1, 2, 0)


def test_fallback_scalars_become_text_and_last_duplicate_wins(spark):
    resp = {5: '{"telefone_profissional": 1, "telefone_profissional": 119876}'}
    r = by_job(extract(jobs_df(spark, [(1, 5, OAB, REQ_FULL, CARD)]), fallback=answers(resp)))[1]
    assert values(r)["telefone_profissional"] == "119876"


@pytest.mark.parametrize("body", ['{"broken": ', '["not", "an", "object"]', None])
def test_fallback_error_keeps_rule_results(spark, body):
    resp = {} if body is None else {5: body}
    ex = extract(jobs_df(spark, [(1, 5, OAB, REQ_FULL, CARD)]), fallback=answers(resp))
    r = by_job(ex)[1]
    assert values(r) == {"nome": "JOANA D'ARC", "inscricao": "123456", "telefone_profissional": None}
    m = r["metadata"]
    assert (m["heuristics_used"], m["llm_used"], m["found_by_llm"]) == (True, False, None)
    assert m["llm_error"]
    # the report counts every requested field as found by rules (reference quirk) ...
    s = stats.per_job(ex.results).collect()[0]
    assert (s["heuristics"], s["llm"], s["found"], s["rules_found"]) == (3, 0, 2, 2)
    # ... and the partial result is cached
    assert ex.new_cache.count() == 1


def test_no_fallback_configured_is_an_error_branch(spark):
    r = by_job(extract(jobs_df(spark, [(1, 5, OAB, REQ_FULL, CARD)])))[1]
    assert r["metadata"]["llm_error"] == "no fallback configured"


def test_cache_partial_off(spark):
    ex = extract(jobs_df(spark, [(1, 5, OAB, REQ_FULL, CARD)]), cache_partial=False)
    assert ex.new_cache.count() == 0


def test_first_writer_and_in_run_hits(spark):
    rows = [(3, 1, OAB, REQ_FOUND, CARD), (1, 2, OAB, REQ_FOUND, CARD), (2, 3, "tela_sistema", REQ_FOUND, CARD)]
    res = by_job(extract(jobs_df(spark, rows)))
    assert [res[j]["metadata"]["cache_hit"] for j in (1, 2, 3)] == [False, True, True]
    # the key ignores the label: job 2 gets job 1's result, computed under the card label
    assert values(res[2]) == {"nome": "JOANA D'ARC", "inscricao": "123456"}
    assert res[2]["metadata"]["label"] == "tela_sistema"
    assert res[2]["metadata"]["found_by_heuristics"] is None


def test_key_can_include_label(spark):
    rows = [(1, 2, OAB, REQ_FOUND, CARD), (2, 3, "tela_sistema", REQ_FOUND, CARD)]
    res = by_job(extract(jobs_df(spark, rows), key_includes_label=True))
    assert res[2]["metadata"]["cache_hit"] is False
    assert values(res[2]) == {"nome": None, "inscricao": None}


def test_key_independent_of_request_order(spark):
    rows = [(1, 1, OAB, {"a": "x", "nome": "y"}, CARD), (2, 2, OAB, {"nome": "y", "a": "x"}, CARD),
            (3, 3, OAB, {"nome": "y", "a": "changed"}, CARD)]
    res = by_job(extract(jobs_df(spark, rows)))
    assert res[1]["cache_key"] == res[2]["cache_key"] != res[3]["cache_key"]


def test_cache_across_runs(spark):
    first = extract(jobs_df(spark, [(1, 1, OAB, REQ_FOUND, CARD)]))
    cache = first.new_cache.select("cache_key", "content_hash", "schema_hash", "result", "created_at")
    second = extract(jobs_df(spark, [(7, 1, OAB, REQ_FOUND, CARD), (8, 2, OAB, REQ_FOUND, CARD + "x")]),
                     cache=cache)
    res = by_job(second)
    m = res[7]["metadata"]
    assert (m["cache_hit"], m["heuristics_used"], m["llm_used"]) == (True, False, False)
    assert values(res[7]) == {"nome": "JOANA D'ARC", "inscricao": "123456"}
    assert res[8]["metadata"]["cache_hit"] is False
    assert second.new_cache.count() == 1
    s = {r["job_id"]: r for r in stats.per_job(second.results).collect()}
    assert (s[7]["heuristics"], s[7]["llm"], s[7]["total_fields"]) == (0, 0, 2)   # hit counts 0 and 0


def test_empty_result_in_cache_is_a_hit(spark):
    first = extract(jobs_df(spark, [(1, 1, OAB, {}, CARD)]))
    res = by_job(extract(jobs_df(spark, [(2, 1, OAB, {}, CARD)]), cache=first.new_cache))
    assert res[2]["metadata"]["cache_hit"] is True and res[2]["result"] == []


def test_empty_request_found_all_no_fallback(spark):
    ex = extract(jobs_df(spark, [(1, 1, OAB, {}, CARD)]), fallback=answers({}))
    r = by_job(ex)[1]
    assert r["result"] == [] and r["metadata"]["llm_used"] is False and ex.requests.count() == 0
    s = stats.per_job(ex.results).collect()[0]
    assert (s["coverage"], s["heuristics_coverage"]) == (0.0, 0.0)


def test_missing_document_is_an_error_row(spark):
    ex = extract(jobs_df(spark, [(1, 1, OAB, REQ_FULL, None), (2, 2, OAB, REQ_FOUND, CARD)]))
    res = by_job(ex)
    assert res[1]["error_class"] == "FILE_NOT_FOUND" and res[1]["result"] is None
    per = stats.per_job(ex.results)
    row = {r["job_id"]: r for r in per.collect()}[1]
    assert (row["total_fields"], row["heuristics"], row["found"], row["missing"]) == (3, 0, 0, 3)
    o = stats.overall(per).collect()[0]
    assert (o["total_files"], o["total_fields"]) == (2, 2)           # error fields not in overall totals
    t = stats.by_type(per).collect()[0]
    assert t["total_fields"] == 5                                     # but in the by-type totals


def test_overall_savings(spark):
    resp = {5: '{"telefone_profissional": "x"}'}
    rows = [(1, 5, OAB, REQ_FULL, CARD), (2, 6, OAB, REQ_FOUND, CARD + " ")]
    per = stats.per_job(extract(jobs_df(spark, rows), fallback=answers(resp)).results)
    o = stats.overall(per).collect()[0]
    assert (o["total_fields"], o["total_heuristics"], o["total_llm"]) == (5, 4, 1)
    assert o["savings_pct"] == pytest.approx(80.0) and o["reduction_factor"] == pytest.approx(5.0)
    assert o["overall_coverage"] == pytest.approx(100.0) and o["calls_saved"] == 4


def test_no_savings_without_fallback_fields(spark):
    per = stats.per_job(extract(jobs_df(spark, [(1, 1, OAB, REQ_FOUND, CARD)])).results)
    o = stats.overall(per).collect()[0]
    assert o["savings_pct"] is None and o["reduction_factor"] is None


def test_result_json_keeps_order_nulls_and_accents(spark):
    ex = extract(jobs_df(spark, [(1, 1, OAB, {"situacao": "s", "telefone": "t"}, CARD)]))
    j = ex.results.select(result_json(F.col("result")).alias("j")).collect()[0]["j"]
    assert j == '{"situacao":"REGULAR","telefone":null}'


def test_hot_key_salting_gives_same_results(spark):
    rows = [(i, i, OAB, REQ_FOUND, CARD if i % 3 else CARD + "\nvariant") for i in range(1, 61)]
    plain = by_job(extract(jobs_df(spark, rows)))
    salted = by_job(extract(jobs_df(spark, rows), hot_rows=5, rows_per_salt=3))
    assert plain.keys() == salted.keys()
    for j in plain:
        assert values(plain[j]) == values(salted[j])
        assert plain[j]["metadata"] == salted[j]["metadata"]


def test_batched_python_fallback(spark):
    """A mapInPandas fallback built from a plain Python answer function."""
    from docsift.operators.fallback import batched

    seen = []

    def answer(requests):
        seen.append(len(requests))
        return [json.dumps({"telefone_profissional": f"tel-{r['doc_id']}"}) for r in requests]

    rows = [(i, i, OAB, REQ_FULL, CARD + "\n" + str(i)) for i in range(1, 6)]
    res = by_job(extract(jobs_df(spark, rows), fallback=batched(answer, batch_size=2)))
    assert {j: values(res[j])["telefone_profissional"] for j in res} == {i: f"tel-{i}" for i in range(1, 6)}
    assert all(res[j]["metadata"]["llm_used"] for j in res)


def test_long_upper_case_runs(spark):
    """Thousands of capital words in a row: the match is that of Python's ``re``, and nothing overflows."""
    import re

    from docsift.operators.rules import oab

    text = "Nome: " + "JOAO SILVA " * 5000 + "fim\n123456"
    rows = [(1, 1, OAB, REQ_FOUND, text), (2, 2, OAB, REQ_FOUND, CARD)]
    res = by_job(extract(jobs_df(spark, rows)))
    assert values(res[1])["nome"] == re.search(oab.NAME, text).group(1).strip()


def test_fully_cached_run_runs_no_rule(spark):
    rows = [(1, 1, OAB, REQ_FOUND, CARD), (2, 2, OAB, REQ_FULL, CARD + "x")]
    first = extract(jobs_df(spark, rows))
    second = extract(jobs_df(spark, rows), cache=first.new_cache)
    assert spark.read.parquet(f"{first.scratch.path}/ruled").count() == 2
    assert spark.read.parquet(f"{second.scratch.path}/ruled").count() == 0
    assert all(r["metadata"]["cache_hit"] for r in second.results.collect())


def test_cleanup_deletes_the_intermediate_tables(spark):
    import os

    run = extract(jobs_df(spark, [(1, 1, OAB, REQ_FOUND, CARD)]))
    path = run.scratch.path.removeprefix("file:")
    assert os.path.isdir(path)
    run.cleanup()
    assert not os.path.exists(path)


def test_text_is_not_shuffled_by_key(spark):
    """The first writer is found on fixed-width columns."""
    from docsift.operators.extract import scan

    keyed = scan(jobs_df(spark, [(1, 1, OAB, REQ_FOUND, CARD)]))
    assert "text" not in keyed.columns


@pytest.mark.parametrize("text, ok", [
    ('{"a": "x"}', True), (' {"a": 1, "b": null} ', True), ("{}", True), ("{'a': 'x'}", False), ('{"a": "x"} more', False),
    ('{"a": "x"} {"a": "y"}', False), ('[{"a": "x"}]', False), ('{"a": "x"', False), ("", False), ("null", False),
    ('{"a": "x"}] x', False), (None, False)])
def test_strict_json(spark, text, ok):
    from docsift.sources.files import parse_request

    fields, error = parse_request(F.col("t"))
    row = spark.createDataFrame([(text,)], "t string").select(fields.alias("f"), error.alias("e")).first()
    assert (row["f"] is not None) == ok and (row["e"] is None) == ok


@pytest.mark.parametrize("few, most", [(1_000_000, 0.7), (3, 0.7), (0, 0.0), (0, 2.0)])
def test_ways_to_pick_the_computing_jobs_agree(spark, monkeypatch, few, most):
    """Broadcast of either side, rules on all jobs, shuffle join: the same results, requests and cache rows."""
    from docsift.operators import extract as X

    monkeypatch.setattr(X, "BROADCAST_IDS", few)
    monkeypatch.setattr(X, "MOST", most)
    texts = [CARD, CARD, "JOANA DUAS", None, "MARIA TRES\n654321", "JOANA DUAS", "OUTRA", "MAIS UMA"]
    jobs = jobs_df(spark, [(i, i, OAB, REQ_FULL if i % 2 else REQ_FOUND, t) for i, t in enumerate(texts * 2)])
    asked = answers({i: f'{{"telefone_profissional": "{i}", "inscricao": "i{i}"}}' for i in range(16)})
    cache = extract(jobs.filter("job_id IN (4, 6)")).new_cache
    ex = extract(jobs, cache=cache, fallback=asked)
    got = {r["job_id"]: (r["error_class"], r["result"] and values(r), r["metadata"] and tuple(r["metadata"])[:5])
           for r in ex.results.collect()}
    asked_for = sorted(r["doc_id"] for r in ex.requests.collect())
    new = sorted((r["content_hash"], str([x["value"] for x in r["result"]])) for r in ex.new_cache.collect())
    seen = _picked.setdefault("ways", (got, asked_for, new))
    assert (got, asked_for, new) == seen and len(got) == 16 and asked_for == [1, 2, 5, 7]


_picked: dict = {}
