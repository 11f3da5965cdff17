"""Sources: file hashing, ledger, manifests, request parsing, first page."""

import hashlib
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from docsift import schema as S
from docsift.sources import files


def _write(dirname, name, data: bytes):
    path = os.path.join(dirname, name)
    with open(path, "wb") as f:
        f.write(data)
    return path


def test_binary_file_hash_matches_hashlib(spark):
    d = tempfile.mkdtemp(prefix="docsift-files-")
    sizes = {"empty.bin": 0, "chunk.bin": 4096, "ten_k.bin": 10000, "odd.bin": 14336, "small.bin": 17}
    expected = {}
    for name, n in sizes.items():
        data = bytes((i * 7 + n) % 256 for i in range(n))
        _write(d, name, data)
        expected[name] = hashlib.sha256(data).hexdigest()
    got = {os.path.basename(r["path"]): r["content_hash"] for r in files.scan_files(spark, d).collect()}
    assert got == expected          # a file of length 0 too



def test_ledger_rehashes_changed_files(spark):
    d = tempfile.mkdtemp(prefix="docsift-ledger-")
    _write(d, "a.bin", b"one")
    _write(d, "b.bin", b"two")
    first = files.scan_files(spark, d)
    ledger = spark.createDataFrame(first.collect(), first.schema)   # a stored ledger table
    _write(d, "b.bin", b"two, changed")           # same path, new length
    _write(d, "c.bin", b"three")
    new = files.new_files(files.scan_files(spark, d), ledger)
    assert sorted(os.path.basename(r["path"]) for r in new.collect()) == ["b.bin", "c.bin"]


def test_text_hash_matches_hashlib(spark):
    df = spark.createDataFrame([("Subseção é",), ("",)], "t string")
    got = [r[0] for r in df.select(S.content_hash(F.col("t"))).collect()]
    assert got == [hashlib.sha256("Subseção é".encode()).hexdigest(), hashlib.sha256(b"").hexdigest()]


def test_manifest_explicit_schema_order_and_duplicates(spark):
    d = tempfile.mkdtemp(prefix="docsift-manifest-")
    text = ('[{"label": "carteira_oab", "extraction_schema": {"nome": "a", "inscricao": "b", "nome": "c"},'
            ' "pdf_path": "oab_1.pdf"},'
            ' {"label": "tela_sistema", "extraction_schema": {"cidade": "Cidade"}, "pdf_path": "tela_1.pdf"}]')
    _write(d, "dataset.json", text.encode())
    rows = files.read_manifest(spark, os.path.join(d, "dataset.json")).orderBy("job_id").collect()
    assert [r["job_id"] for r in rows] == [1, 2]
    # a repeated key keeps its first position and its last value, like a Python dict
    assert [(f["field"], f["description"]) for f in rows[0]["fields"]] == [("nome", "c"), ("inscricao", "b")]
    assert rows[1]["doc_id"] == "tela_1.pdf"


def test_manifest_of_lines_is_read_by_many_tasks(spark):
    entries = [json.dumps({"label": f"l{i}", "extraction_schema": {"f": "x" * (i % 50), "g": "[,]"}, "pdf_path": f"{i}.pdf"})
               for i in range(400)]
    d = tempfile.mkdtemp(prefix="docsift-manifest-")
    lines = [f"{e}," for e in entries[:-1]] + [entries[-1] + " ]"]
    lines[0] = "[" + lines[0]
    lines[7:9] = [lines[7] + " " + lines[8]]                        # two entries on a line, and empty lines
    lines.insert(20, "")
    _write(d, "part-0.json", "\n".join(lines[:150]).encode())
    _write(d, "part-1.json", "\r\n".join(lines[150:]).encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4000)
    try:
        got = files.read_manifest(spark, d).collect()
        assert sorted((r["job_id"], r["label"], r["doc_id"]) for r in got) == [
            (i + 1, f"l{i}", f"{i}.pdf") for i in range(400)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_manifest_layouts(spark):
    e = [{"label": f"l{i}", "extraction_schema": {"f": "d"}, "pdf_path": f"{i}"} for i in range(3)]
    one = json.dumps(e[0])
    for name, text, n in (("indented", json.dumps(e, indent=2), 3), ("empty", "[]", 0), ("apart", "[\n]\n", 0),
                          ("brackets", "[\n" + ",\n".join(map(json.dumps, e)) + "\n]\n", 3)):
        d = tempfile.mkdtemp(prefix="docsift-manifest-")
        rows = files.read_manifest(spark, _write(d, f"{name}.json", text.encode())).collect()
        assert sorted((r["job_id"], r["doc_id"]) for r in rows) == [(i + 1, f"{i}") for i in range(n)], name
    for bad in (f"[{one}\n{one}]", f"[{one},\n]", f"[{one},\n,\n{one}]", f"[{one},\n{{bad]"):
        d = tempfile.mkdtemp(prefix="docsift-manifest-")
        with pytest.raises(Exception):
            files.read_manifest(spark, _write(d, "bad.json", bad.encode())).collect()


def test_manifest_query_gathers_no_rows(spark, monkeypatch):
    """No step of the query may hold the whole manifest in one row: entries are written by several tasks."""
    from sf_paths import SF_SMALL

    from docsift import catalog
    read, seen = files.read_manifest, []
    monkeypatch.setattr(files, "read_manifest", lambda s, p: seen.append(s.read.text(p, wholetext=True).count()) or read(s, p))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        n = catalog.manifest_jobs(spark, SF_SMALL).count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert n == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count() and seen[0] > 1


def test_jobs_as_json_lines(spark):
    d = tempfile.mkdtemp(prefix="docsift-jobs-")
    lines = [json.dumps({"job_id": i, "label": "x", "extraction_schema": {"f": "d"}, "pdf_path": f"{i}.pdf"})
             for i in range(3)]
    _write(d, "jobs.jsonl", "\n".join(lines).encode())
    assert files.read_jobs(spark, os.path.join(d, "jobs.jsonl")).count() == 3


def test_request_parse_errors(spark):
    df = spark.createDataFrame([('{"a": "x"}',), ("{bad",), ('["a"]',), ("{}",)], "r string")
    fields, err = files.parse_request(F.col("r"))
    got = [(len(r["f"]) if r["f"] is not None else None, r["e"]) for r in df.select(
        fields.alias("f"), err.alias("e")).collect()]
    assert got == [(1, None), (None, "SCHEMA_ERROR"), (None, "SCHEMA_ERROR"), (0, None)]


def test_first_page_and_zero_pages(spark):
    pages = spark.createDataFrame([(1, 2, "p2"), (1, 0, "p0"), (1, 1, "p1"), (2, 5, "only")],
                                  "doc_id long, page_no long, text string")
    got = {r["doc_id"]: r["text"] for r in files.first_page(pages).collect()}
    assert got == {1: "p0", 2: "only"}
    docs = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    errs = files.zero_page_errors(docs, pages).collect()
    assert [(r["doc_id"], r["error_class"]) for r in errs] == [(3, "ZERO_PAGES")]


def test_results_json_sink(spark):
    import json as _json

    from docsift.operators.extract import extract
    from docsift.sources.sinks import write_results_json

    df = spark.createDataFrame([(1, 1, "carteira_oab", '{"situacao": "s", "nome": "n"}', "SITUAÇÃO ÓTIMA")],
                               "job_id long, doc_id long, label string, request string, text string")
    fields, _ = files.parse_request(F.col("request"))
    jobs = df.select("job_id", "doc_id", "label", fields.alias("fields"), "text")
    out = tempfile.mkdtemp(prefix="docsift-sink-") + "/results"
    write_results_json(extract(jobs).results, out)
    rows = [_json.loads(line) for p in sorted(os.listdir(out)) if p.endswith(".json")
            for line in open(os.path.join(out, p), encoding="utf-8")]
    assert len(rows) == 1
    assert rows[0]["result_json"] == '{"situacao":"ÓTIMA","nome":"SITUAÇÃO ÓTIMA"}'
