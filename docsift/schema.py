"""Types and schema-level Column helpers.

A requested schema arrives as ``map<string,string>`` (field -> description). Inside
the engine it is an ordered ``array<struct<ord,field,description>>`` so that the
output keeps request order and duplicate keys can be resolved like a Python dict.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

REQUEST_SCHEMA = T.MapType(T.StringType(), T.StringType())

FIELD = T.StructType([
    T.StructField("ord", T.IntegerType()),
    T.StructField("field", T.StringType()),
    T.StructField("description", T.StringType()),
])
FIELDS = T.ArrayType(FIELD)

# Manifest entry as written by users: the schema is a map, never inferred.
MANIFEST_ENTRY = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("extraction_schema", REQUEST_SCHEMA),
    T.StructField("pdf_path", T.StringType()),
])
MANIFEST = T.ArrayType(MANIFEST_ENTRY)

# One extracted field: value is null when not found; source says which level found it.
RESULT_FIELD = T.StructType([
    T.StructField("ord", T.IntegerType()),
    T.StructField("field", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("source", T.StringType()),
])

# Cache table: one row per (content, request) key.
CACHE = T.StructType([
    T.StructField("cache_key", T.StringType(), False),
    T.StructField("content_hash", T.StringType()),
    T.StructField("schema_hash", T.StringType()),
    T.StructField("result", T.ArrayType(T.StructType([
        T.StructField("field", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("raw", T.StringType()),
    ]))),
    T.StructField("created_at", T.TimestampType()),
])


def fields_of(request: Column) -> Column:
    """``map<string,string>`` -> ordered ``array<struct<ord,field,description>>``."""
    return F.transform(
        F.map_entries(request),
        lambda e, i: F.struct(i.alias("ord"), e["key"].alias("field"), e["value"].alias("description")),
    )


def dedupe_fields(fields: Column) -> Column:
    """Resolve repeated field names the way a Python dict built from JSON does.

    A JSON object with a repeated key keeps the *first* position and the *last*
    value. Spark's JSON map reader keeps every entry, so apply this on parse paths.
    """
    firsts = F.filter(
        fields,
        lambda f, i: ~F.exists(F.slice(fields, 1, i), lambda g: g["field"] == f["field"]),
    )
    return F.transform(
        firsts,
        lambda f, i: F.struct(
            i.alias("ord"),
            f["field"].alias("field"),
            F.aggregate(fields, f["description"],
                        lambda acc, g: F.when(g["field"] == f["field"], g["description"])
                        .otherwise(acc)).alias("description"),
        ),
    )


def json_object(text: Column, values: str = "string") -> Column:
    """``map<string, values>`` of a JSON object text; null unless the whole text is one valid object.

    The text is read as a member of an object of ours, and the member after it must be reached: so trailing
    text, a second object and an unfinished one are all rejected, and single quotes are no quotes.
    """
    wrapped = F.concat(F.lit('{"v":'), text, F.lit(',"end":1}'))
    parsed = F.from_json(wrapped, f"v map<string,{values}>, end int", {"allowSingleQuotes": "false"})
    return F.when(parsed["end"] == 1, parsed["v"])


def sorted_json(text: Column) -> Column:
    """A description that is itself a JSON object, with its keys sorted; any other text as it is."""
    entries = F.map_entries(json_object(text))
    ordered = F.array_sort(F.transform(entries, lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v"))))
    return F.when(F.startswith(F.ltrim(text), F.lit("{")), F.coalesce(F.to_json(ordered), text)).otherwise(text)


def schema_hash(fields: Column) -> Column:
    """SHA-256 of a canonical form of the request: entries sorted by field name, also those of a description
    that is a JSON object.

    Two requests with the same fields and descriptions in another order get the
    same hash; any change of a name or description changes it.
    """
    entries = F.transform(fields, lambda f: F.struct(f["field"].alias("k"), sorted_json(f["description"]).alias("v")))
    return F.sha2(F.to_json(F.sort_array(entries)), 256)


def content_hash(content: Column) -> Column:
    """SHA-256 hex of the document bytes (text is hashed as its UTF-8 bytes)."""
    return F.sha2(content.cast("binary"), 256)


def cache_key(content_hash_col: Column, schema_hash_col: Column, label: Column | None = None) -> Column:
    """``content_hash:schema_hash``; with ``label`` given, the label is part of the key."""
    if label is None:
        return F.concat_ws(":", content_hash_col, schema_hash_col)
    return F.concat_ws(":", content_hash_col, schema_hash_col, F.sha2(label, 256))


def packed_key(key: Column, *, formed: bool = False) -> Column:
    """A cache key as the bytes that its hashes spell, half as long; null for a text that is none.

    ``formed``: the keys come from :func:`cache_key`, so their form needs no check.
    """
    packed = F.unhex(F.replace(key, F.lit(":"), F.lit("")))
    return packed if formed else F.when(key.rlike(r"\A[0-9a-f]{64}(:[0-9a-f]{64}){0,2}\z"), packed)


def unpacked_key(packed: Column) -> Column:
    """The cache key that :func:`packed_key` made the bytes of."""
    hashes = [F.substring(packed, 1 + 32 * i, 32) for i in range(3)]
    return F.when(packed.isNotNull(), F.concat_ws(":", *[
        F.when(F.octet_length(h) > 0, F.lower(F.hex(h))) for h in hashes]))
