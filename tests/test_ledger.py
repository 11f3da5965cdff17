"""The file ledger: distributed listing and reading, runs that repeat, streams of files."""

import hashlib
import os

import pytest

from docsift.sources import files, ledger
from docsift.streaming.incremental import new_store


def put(folder, **contents):
    for name, data in contents.items():
        path = os.path.join(folder, *name.split("__"))
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(data)


def names(rows):
    return sorted(os.path.basename(r["path"]) for r in rows.collect())


def test_walk_lists_what_spark_lists(spark, tmp_path):
    put(tmp_path, a=b"one", empty=b"", sub__deep__b=b"22", sub__c=b"", _hidden=b"x", sub___skip__d=b"y", **{".dot": b"z"})
    got = sorted((r["path"], r["length"], r["modificationTime"]) for r in ledger.walk(spark, str(tmp_path)).collect())
    want = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path))
            .select("path", "length", "modificationTime").collect())
    assert [(p, n) for p, n, _ in got] == [(f"file:{tmp_path}/{n}", s) for n, s in
                                           (("a", 3), ("empty", 0), ("sub/c", 0), ("sub/deep/b", 2))]
    assert {tuple(r) for r in want} <= set(got)                    # Spark leaves empty files out
    assert names(ledger.walk(spark, str(tmp_path), glob="?")) == ["a", "b", "c"]


def test_ledger_reads_only_what_it_lacks(spark, tmp_path, monkeypatch):
    table, folder = ledger.Ledger(spark, new_store(spark, "test-ledger")), tmp_path / "in"
    put(folder, a=b"one", b=b"two", sub__empty=b"")
    first = table.update(0, str(folder))
    assert {os.path.basename(r["path"]): r["content_hash"] for r in first.collect()} == {
        n: hashlib.sha256(d).hexdigest() for n, d in (("a", b"one"), ("b", b"two"), ("empty", b""))}
    put(folder, b=b"two, changed", c=b"three")                    # same path, another length
    assert names(table.update(1, str(folder))) == ["b", "c"]
    assert names(table.update(1, str(folder))) == ["b", "c"]      # the run repeated: the same rows, once
    assert table.rows().count() == 5
    current = {os.path.basename(r["path"]): r["content_hash"] for r in table.current().collect()}
    assert current["b"] == hashlib.sha256(b"two, changed").hexdigest() and len(current) == 4
    os.chmod(folder / "a", 0)
    assert table.update(2, str(folder)).count() == 0              # known files are not opened
    os.chmod(folder / "a", 0o644)


def test_no_path_passes_the_driver(spark, tmp_path, monkeypatch):
    """The driver reads back at most one row of any step."""
    put(tmp_path / "in", **{f"f{i}": bytes([i]) for i in range(30)})
    cls = type(spark.range(1))
    for name in ("collect", "toLocalIterator", "toPandas", "toArrow"):
        monkeypatch.setattr(cls, name, lambda *_: pytest.fail("rows came to the driver"))
    monkeypatch.setattr(cls, "isEmpty", lambda self: self.limit(1).count() == 0)
    assert ledger.Ledger(spark, new_store(spark, "test-ledger")).update(0, str(tmp_path / "in")).count() == 30


def test_a_large_file_is_hashed_in_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "CHUNK", 1000)
    data = os.urandom(123_457)
    put(tmp_path, big=data)
    assert ledger.hash_files(ledger.walk(spark, str(tmp_path))).first()["content_hash"] == hashlib.sha256(data).hexdigest()


def test_a_file_that_changes_fails_the_run(spark, tmp_path):
    put(tmp_path, a=b"one")
    listing = ledger.walk(spark, str(tmp_path))
    put(tmp_path, a=b"longer now")
    with pytest.raises(Exception, match="changed"):
        ledger.hash_files(listing).collect()


def test_stream_of_files_reads_each_once(spark, tmp_path):
    folder, store = tmp_path / "in", new_store(spark, "test-files")
    put(folder, a=b"one", sub__b=b"two")
    ledger.stream_files(spark, str(folder), store, files_per_batch=1).awaitTermination()
    put(folder, c=b"three")
    ledger.stream_files(spark, str(folder), store).awaitTermination()              # starts again where it was
    got = ledger.streamed_files(spark, store)
    assert names(got) == ["a", "b", "c"]
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in files.scan_files(spark, str(folder)).collect()} | {
        tuple(r) for r in files.scan_files(spark, str(folder / "sub")).collect()}


def test_written_files_are_whole_and_repeatable(spark, tmp_path):
    df = spark.createDataFrame([("x.txt", b"abc"), ("y.txt", b"")], "name string, content binary")
    for _ in range(2):
        assert sorted((os.path.basename(r[0]), r[1]) for r in ledger.write_files(df, str(tmp_path / "out")).collect()) == [
            ("x.txt", 3), ("y.txt", 0)]
    assert sorted(os.listdir(tmp_path / "out")) == ["x.txt", "y.txt"]
