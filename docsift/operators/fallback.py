"""Third level: ask a caller-supplied fallback for the fields the rules missed.

The engine never calls a model service itself. It builds a *request queue* (one
row per distinct cache key whose rules left a field null: the missing
sub-schema, a rendered prompt and chat messages) and hands it to the caller's
``fallback(requests) -> DataFrame(request_id, response_json)``, which may be a
table of stored answers, a ``mapInPandas`` client with its own rate limits, or
nothing at all. Responses are parsed with ``from_json`` and merged back: only
fields that were null are filled.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift import schema as S

Fallback = Callable[[DataFrame], DataFrame]

DEFAULT_MODEL = "gpt-5-mini"        # fixed value: the reference's configured model
RESPONSE_FORMAT = "json_object"

SYSTEM_MESSAGE = (
    "You extract structured fields from documents. Reply with a single JSON object, "
    "and only report information that is plainly present in the text."
)

ERR_NO_FALLBACK = "no fallback configured"
ERR_NO_RESPONSE = "fallback returned no response"
ERR_NOT_OBJECT = "fallback response is not a JSON object"


def json_string(s: Column) -> Column:
    """A string as a JSON string literal (quotes and escapes; non-ASCII kept)."""
    j = F.to_json(F.array(s))
    return F.substring(j, F.lit(2), F.length(j) - 2)


def schema_block(fields: Column) -> Column:
    """Indent-2 JSON object of ``field: description`` in request order; ``{}`` when empty."""
    lines = F.transform(fields, lambda f: F.concat(F.lit("  "), json_string(f["field"]), F.lit(": "),
                                                   json_string(f["description"])))
    return F.when(F.size(fields) == 0, F.lit("{}")).otherwise(
        F.concat(F.lit("{\n"), F.array_join(lines, ",\n"), F.lit("\n}")))


PROMPT_HEAD = ("Fill in this form from the document that follows it. Each key of the form is a field; the text "
               "beside it says what belongs there. Reply with one JSON object that has exactly these keys, and "
               "null where the document is silent.\n\n")
PROMPT_MID = "\n\nDocument:\n<<<\n"
PROMPT_TAIL = "\n>>>"


def render_prompt(text: Column, fields: Column) -> Column:
    """User prompt: the task, the form, the document between marks."""
    return F.concat(F.lit(PROMPT_HEAD), schema_block(fields), F.lit(PROMPT_MID),
                    F.coalesce(text, F.lit("")), F.lit(PROMPT_TAIL))


def build_requests(pending: DataFrame, *, model: str = DEFAULT_MODEL) -> DataFrame:
    """Request rows from ``pending(request_id, doc_id, label, text, missing)``.

    ``missing`` is the ordered sub-schema ``array<struct<ord,field,description>>``.
    """
    prompt = render_prompt(F.col("text"), F.col("missing"))
    return pending.select(
        "request_id", "doc_id", "label", "missing",
        prompt.alias("prompt"),
        F.struct(
            F.lit(model).alias("model"),
            F.array(
                F.struct(F.lit("system").alias("role"), F.lit(SYSTEM_MESSAGE).alias("content")),
                F.struct(F.lit("user").alias("role"), prompt.alias("content")),
            ).alias("messages"),
            F.struct(F.lit(RESPONSE_FORMAT).alias("type")).alias("response_format"),
        ).alias("request"),
    )


def parse_response(response_json: Column) -> Column:
    """JSON object text -> ``map<string,variant>``; null when malformed or not an object."""
    return S.json_object(response_json, "variant")


def answer_for(parsed: Column, name: Column) -> Column:
    """Value of key ``name`` (a variant) in a parsed response; a repeated key keeps its last value."""
    found = F.filter(F.map_entries(parsed), lambda e: e["key"] == name)
    return F.get(found, F.size(found) - 1)["value"]


def response_error(has_row: Column, response_json: Column, parsed: Column, configured: bool) -> Column:
    if not configured:
        return F.lit(ERR_NO_FALLBACK)
    return (F.when(~has_row | response_json.isNull(), F.lit(ERR_NO_RESPONSE))
            .when(parsed.isNull(), F.lit(ERR_NOT_OBJECT)))


def batched(answer: Callable[[list[dict]], list[str | None]], *, batch_size: int = 64) -> Fallback:
    """Turn ``answer(requests) -> response JSON texts`` into a distributed fallback.

    ``answer`` gets plain dicts (``request_id``, ``doc_id``, ``label``, ``prompt``,
    ``request``) in batches of at most ``batch_size`` - e.g. to call a model
    service with its own client and rate limit - and returns one JSON text (or
    None) per request. It runs inside ``mapInPandas`` on the executors; only the
    request columns travel to Python.
    """
    def run(batches):
        for pdf in batches:
            rows = pdf.to_dict("records")
            out = []
            for i in range(0, len(rows), batch_size):
                chunk = rows[i:i + batch_size]
                answers = list(answer(chunk))
                if len(answers) != len(chunk):
                    raise ValueError("fallback returned a different number of answers than requests")
                out.extend(answers)
            yield pd.DataFrame({"request_id": [r["request_id"] for r in rows], "response_json": out},
                               columns=["request_id", "response_json"])

    def fallback(requests: DataFrame) -> DataFrame:
        cols = requests.select("request_id", "doc_id", "label", "prompt",
                               F.to_json("request").alias("request"))
        return cols.mapInPandas(run, "request_id string, response_json string")

    return fallback
