"""Manifests in any layout, cut by many tasks."""

import json
import random

import pytest

from docsift.sources import files

ODD = ['}', '{', '"', '\\', '\\"', '}]', '[{', ',', '\n', 'é', '{"a": "}"}', ' ', "'"]


def entries(n, seed=1):
    rng = random.Random(seed)
    return [{"label": f"l{i}" + rng.choice(ODD), "extraction_schema": {f"f{k}" + rng.choice(ODD): rng.choice(ODD) * rng.randint(0, 9)
                                                                      for k in range(rng.randint(0, 3))},
             "pdf_path": f"{i}.pdf"} for i in range(n)]


@pytest.fixture(autouse=True)
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", 700)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("layout", ["indented", "one line", "lines", "apart", "folder", "ascii"])
def test_layouts(spark, tmp_path, layout):
    given = entries(60)
    text = {"indented": json.dumps(given, indent=2, ensure_ascii=False), "one line": json.dumps(given, ensure_ascii=False),
            "lines": "[" + ",\n".join(json.dumps(e) for e in given) + "]\n", "ascii": json.dumps(given),
            "apart": " \n[\r\n" + "\n,\t".join(json.dumps(e, indent=1) for e in given) + "\n]\n\n"}.get(layout)
    if layout == "folder":
        parts = [json.dumps(e) + ("," if i < 59 else " ]") for i, e in enumerate(given)]
        for k in range(4):                                     # a file may end with a brace, a comma stands in the next
            body = "\n".join(parts[15 * k:15 * k + 15])
            (tmp_path / f"part-{k}.json").write_bytes((("[" if k == 0 else "") + body).encode())
        (tmp_path / "part-1.json").write_bytes("\n".join(parts[15:30]).rstrip(",").encode())
        (tmp_path / "part-2.json").write_bytes(("," + "\n".join(parts[30:45])).encode())
    else:
        (tmp_path / "m.json").write_bytes(text.encode())
    pieces = files.placed_pieces(spark, str(tmp_path), "}")
    assert pieces.select("file", "block").distinct().count() > 4                     # many splits
    got = sorted(files.read_manifest(spark, str(tmp_path)).collect())
    assert [(r["job_id"], r["label"], r["doc_id"], {f["field"]: f["description"] for f in r["fields"]}) for r in got] == [
        (i + 1, e["label"], e["pdf_path"], e["extraction_schema"]) for i, e in enumerate(given)]


@pytest.mark.parametrize("bad", ["", "{}", "[", "[{}", "[{}}]", "[{},]", "[{}{}]", "[{} ,, {}]", "[{}]]", "[{}] x", "x [{}]", "[1]",
                                 '[{"label": "a]', '[{"label": "a}"]', "[{]}", "[[{}]]", '[{"label": "\\}"}]', "[{'label': 'x'}]",
                                 '[{"label": 1 2}]'])
def test_what_is_no_array_of_objects_fails(spark, tmp_path, bad):
    (tmp_path / "m.json").write_text(bad)
    with pytest.raises(Exception):
        files.read_manifest(spark, str(tmp_path / "m.json")).collect()


@pytest.mark.parametrize("empty", ["[]", " [ \n ] \n", "[\n]\n"])
def test_empty_arrays(spark, tmp_path, empty):
    (tmp_path / "m.json").write_text(empty)
    assert files.read_manifest(spark, str(tmp_path / "m.json")).count() == 0
