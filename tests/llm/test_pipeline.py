"""The pipeline's stages and run() against plain Python; the registered queries against SQL and each other."""

import duckdb
import public_tokenizers
import pytest
from corpus_fixtures import brute_components, brute_decontamination, crc, documents, ordered, sha, space_words, table

import __spark_entry__ as E
import corpus_pipeline
from conftest import SMALL
from docsift.llm import language_id, oracle_sql, queries, tokens

ROWS = [r for r in documents(3, 48) if r[0] is not None]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("pipeline")
    table(spark, ROWS).select(*COLUMNS).repartition(3).write.parquet(f"{d}/documents.parquet")
    items = [(1, ROWS[3][1][:200]), (2, None)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), items


def normal(text):
    return "".join(space_words(text))


def best_copies(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append((-len(t), i, t))
    return [(i, t) for _, i, t in map(min, groups.values())]


def test_stages_and_run(spark, folder):
    d, items = folder
    docs = spark.read.parquet(f"{d}/documents.parquet")
    left = ROWS
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == COLUMNS
        out.write.parquet(f"{d}/{name}")
        docs = spark.read.parquet(f"{d}/{name}")
        got = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "language_id":
            net = language_id.fit(spark.read.parquet(f"{d}/documents.parquet"))
            ids = language_id.predict(spark.read.parquet(f"{d}/documents.parquet"), net).collect()
            bad = {r.doc_id for r in ids if r.lang_pred == "und" or r.score < corpus_pipeline.LEAST_SCORE}
            assert {i for i, t in ROWS if not (t or "").strip()} <= bad | {i for i, t in ROWS if (t or "").strip()}
            expected = [r for r in left if r in got]
            assert all(t is not None and any(c.isalpha() for c in t) for _, t in got) and len(got) > 30
        elif name == "exact_dedup":
            expected = best_copies(left)
        elif name == "jaccard_join":
            labels, _ = brute_components(left, 5, 4, 5)
            first = {}
            for label, r in zip(labels, left):
                first[label] = min(first.get(label, r), r, key=lambda x: x[0])
            expected = list(first.values())
        else:
            bad = {r[0] for r in brute_decontamination(left, items) if r[5]}
            expected = [r for r in left if r[0] not in bad]
            assert bad
        assert ordered(got) == ordered(expected), name
        left = expected
    library = tokens.load(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: library.encode(t, add_special_tokens=False).ids + [2] for i, t in left}
    for got in (corpus_pipeline.STAGES[-1][1](spark, docs, d).collect(), corpus_pipeline.run(spark, d).collect()):
        assert {r.doc_id for r in got} == set(ids)
        assert sum(r.length for r in got) == sum(map(len, ids.values()))
        assert all(crc(ids[r.doc_id][r.start:r.start + r.length]) == r.ids_crc32 for r in got)


def test_language_stage_keeps_exactly_the_recognised(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    labels = language_id.predict(docs, language_id.fit(docs)).collect()
    scores = sorted(r.score for r in labels if r.lang_pred != "und")
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    for least in (corpus_pipeline.LEAST_SCORE, scores[len(scores) // 2]):       # the second one drops about half
        monkeypatch.setattr(corpus_pipeline, "LEAST_SCORE", least)
        known = {(r.doc_id, r.score) for r in labels if r.lang_pred != "und" and r.score >= least}
        texts = dict(ROWS)
        unlike = {i for i, _ in ROWS if sum(j == i for j, _ in ROWS) > 1}      # doc_ids of several texts
        got = [(r.doc_id, r.text) for r in stage(spark, docs, folder[0]).collect()]
        assert ordered(r for r in got if r[0] not in unlike) == ordered(
            (i, texts[i]) for i in {i for i, _ in known} - unlike)
        assert len(got) == sum(r.lang_pred != "und" and r.score >= least for r in labels)


def test_pipeline_on_an_empty_table(spark, folder, tmp_path):
    table(spark, []).select(*COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder[0]}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    names = [n for n in E.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 11)) and "pipeline" in names
    assert set(oracle_sql.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(oracle_sql.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = queries.queries()[name](spark, SMALL)
    rel = con.sql(oracle_sql.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert ordered(df.select(*sorted(df.columns)).collect()) == ordered(rel.select(*sorted(rel.columns)).fetchall())
