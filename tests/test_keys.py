"""Cache-key properties (content + request), table-driven."""

import json

import pytest
from pyspark.sql import functions as F

from docsift import schema as S
from docsift.sources.files import parse_request

BASE_TEXT = "CONTEÚDO 123456"
BASE_REQ = {"nome": "Nome", "inscricao": "Número de inscrição"}

# (case, text, request, same key as the base?)
CASES = [
    ("same_content_other_document", BASE_TEXT, BASE_REQ, True),
    ("request_order_does_not_matter", BASE_TEXT, {"inscricao": "Número de inscrição", "nome": "Nome"}, True),
    ("one_byte_of_content_changes_it", BASE_TEXT + " ", BASE_REQ, False),
    ("description_change_changes_it", BASE_TEXT, {"nome": "Nome completo", "inscricao": "Número de inscrição"}, False),
    ("field_name_change_changes_it", BASE_TEXT, {"nome_": "Nome", "inscricao": "Número de inscrição"}, False),
    ("extra_field_changes_it", BASE_TEXT, {**BASE_REQ, "cpf": "CPF"}, False),
    ("empty_request_is_a_key_too", BASE_TEXT, {}, False),
]


@pytest.fixture(scope="module")
def keys(spark):
    rows = [("base", BASE_TEXT, json.dumps(BASE_REQ, ensure_ascii=False))]
    rows += [(c, t, json.dumps(r, ensure_ascii=False)) for c, t, r, _ in CASES]
    df = spark.createDataFrame(rows, "case string, text string, request string")
    fields, _ = parse_request(F.col("request"))
    out = df.select("case", S.cache_key(S.content_hash(F.col("text")), S.schema_hash(fields)).alias("k"))
    return {r["case"]: r["k"] for r in out.collect()}


@pytest.mark.parametrize("case", CASES, ids=[c[0] for c in CASES])
def test_key_property(keys, case):
    name, _text, _req, same = case
    assert (keys[name] == keys["base"]) is same


def test_key_shape(keys):
    content, request = keys["base"].split(":")
    assert len(content) == 64 and len(request) == 64
    assert len(set(keys.values())) == len(keys) - 2      # two cases share the base key
