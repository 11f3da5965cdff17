"""Rule engine: label bank, then generic bank, for every requested field.

Per row (one document + one request):

1. ``plan``   - which extractor each field's label rule / generic rule uses;
2. ``needed`` - the distinct extractors the plan refers to;
3. all needed extractors in one projection - a lambda holds what an alternative
   gave, and the next alternative stands inside it, for where that missed. So every
   regex runs at most once per row (a regex inside a conditional branch is not
   shared by Spark's subexpression elimination), an alternative that is not needed
   never runs, and no row is copied from one alternative to the next;
4. ``rule_values`` - per field ``coalesce(label value, generic value)``.

Built-in expressions only. No shuffle, no UDF.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from docsift.functions.regex import found, rx, strip
from docsift.operators.rules import DEFAULT, Alt, Extractor, RuleSet
from docsift.plans.rule_plan import family, field_plan
from docsift.schema import schema_hash

SOURCE_LABEL = "label_rules"
SOURCE_GENERIC = "generic_rules"


def _needed(plan: Column, rules: RuleSet) -> Column:
    """For each extractor index, whether the plan refers to it."""
    indexes = F.array(*[F.lit(i) for i in range(len(rules.extractor_ids))])
    used = F.flatten(F.transform(plan, lambda p: F.array(p["label_x"], p["generic_x"])))
    return F.transform(indexes, lambda i: F.exists(used, lambda x: x.eqNullSafe(i)))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, and only where the whole is."""
    return F.get(F.transform(F.array(value), use), 0)


def _raw(alt: Alt, text: Column) -> Column:
    """Unfinished value of one alternative: ``''`` (or empty array) when it does not match."""
    pattern = rx(alt.java or alt.pattern, alt.flags)
    if alt.many:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(alt.group))
    return F.regexp_extract(text, pattern, alt.group)


def _missed(alt: Alt, raw: Column) -> Column:
    return (F.size(raw) == 0) if alt.many else (raw == F.lit(""))


def _finish(alt: Alt, raw: Column) -> Column:
    """Finished value of one alternative that matched (``many``: or found none)."""
    v = strip(raw) if alt.strip and not alt.many else raw
    return alt.finish(v) if alt.finish else v


def _first_match(alts: tuple[Alt, ...], text: Column) -> Column:
    """Value of the first alternative that matches; one whose gate is shut ends the search, as null."""
    alt, later = alts[0], alts[1:]

    def of(raw: Column) -> Column:
        missed = ([_finish(alt, raw)] if alt.many else []) + ([_first_match(later, text)] if later else [])
        return F.when(_missed(alt, raw), F.coalesce(*missed) if missed else F.lit(None)).otherwise(_finish(alt, raw))

    value = _let(_raw(alt, text), of)
    return F.when(found(text, *alt.gate), value) if alt.gate else value


def extractor_value(ext: Extractor, text: Column, need: Column | None) -> Column:
    """Value of one extractor where ``need`` holds (None: everywhere), else null."""
    value, conds = _first_match(ext.alts, text), [] if need is None else [need]
    if ext.gate:
        conds.append(found(text, *ext.gate))
    return F.when(reduce(and_, conds), value) if conds else value


def staged_values(df: DataFrame, text: str, needed: Column | None, ids=None,
                  rules: RuleSet = DEFAULT) -> DataFrame:
    """Add one finished column ``_v<i>`` per extractor index ``i`` in ``ids``.

    ``needed``: array<boolean> Column, by extractor index, of those to run (None: all of ``ids``).
    """
    ids = rules.extractor_ids if ids is None else ids
    index = {x: rules.extractor_index[x] for x in ids}
    return df.withColumns({f"_v{i}": extractor_value(rules.extractors[x], F.col(text),
                                                     None if needed is None else F.get(needed, F.lit(i)))
                           for x, i in index.items()})


def _field_value(plan_entry: Column, vals: Column) -> Column:
    by_label = F.get(vals, plan_entry["label_x"])
    by_generic = F.get(vals, plan_entry["generic_x"])
    return F.struct(
        plan_entry["ord"].alias("ord"),
        plan_entry["field"].alias("field"),
        F.coalesce(by_label, by_generic).alias("value"),
        F.when(by_label.isNotNull(), F.lit(SOURCE_LABEL))
        .when(by_generic.isNotNull(), F.lit(SOURCE_GENERIC)).alias("source"),
    )


def plan_table(df: DataFrame, keep, *, label: str = "label", fields: str = "fields",
               max_plans: int = 100_000, max_bytes: int = 64 << 20,
               rules: RuleSet = DEFAULT) -> DataFrame | None:
    """One plan per distinct (bank, request), or None when there are too many to broadcast.

    Plans depend on the label only through its bank, so a billion jobs asking a
    handful of requests need a handful of plans. The distinct requests are written
    once (``keep``: DataFrame -> table), counted and sized; above ``max_plans`` rows
    or ``max_bytes`` the caller evaluates the plan inline per row instead. Each plan
    row also carries the request's order-free hash.
    """
    keyed = df.select(F.coalesce(family(F.col(label), rules), F.lit("")).alias("_family"),
                      F.col(fields).alias("_fields")).filter(F.col("_fields").isNotNull())
    plans = keep(keyed.distinct().select(
        "_family", "_fields", field_plan(None, F.col("_fields"), rules, bank=F.col("_family")).alias("_plan"),
        schema_hash(F.col("_fields")).alias("_schema_hash")).withColumn("_needed", _needed(F.col("_plan"), rules)))
    stats = plans.agg(F.count(F.lit(1)).alias("n"),
                      F.coalesce(F.sum(F.length(F.to_json("_fields"))), F.lit(0)).alias("bytes")).first()
    if stats["n"] > max_plans or stats["bytes"] * 3 > max_bytes:   # x3: plan adds rule columns
        return None
    return plans


def attach_plans(df: DataFrame, plans: DataFrame, *, label: str = "label", fields: str = "fields",
                 rules: RuleSet = DEFAULT) -> DataFrame:
    """Broadcast-join the plan table on (bank, request): adds ``_plan``, ``_needed`` and ``_schema_hash``.

    A stored table's columns may all be null, those of the request not; the join would copy the request of every job to the
    other type. So the few plans are brought to the request's type.
    """
    keys = plans.withColumn(fields, _never_null(F.col("_fields"), df.schema[fields].dataType)).drop(
        *(["_fields"] if fields != "_fields" else []))
    return (df.withColumn("_family", F.coalesce(family(F.col(label), rules), F.lit("")))
            .join(F.broadcast(keys), ["_family", fields], "left")
            .drop("_family"))


def _never_null(requests: Column, kind: ArrayType) -> Column:
    """The same requests, in a column whose type says of the same members as ``kind`` that they are never null."""
    member = kind.elementType
    if kind.containsNull or not isinstance(member, StructType):
        return requests
    zero = {"ord": F.lit(0), "field": F.lit(""), "description": F.lit("")}
    return F.transform(requests, lambda f: F.struct(*[
        (f[m.name] if m.nullable or m.name not in zero else F.coalesce(f[m.name], zero[m.name])).alias(m.name)
        for m in member.fields]))


def apply_rules(df: DataFrame, *, label: str = "label", fields: str = "fields",
                text: str = "text", keep_plan: bool = False, plans: DataFrame | None = None,
                rules: RuleSet = DEFAULT) -> DataFrame:
    """Add ``rule_values`` (ordered ``array<struct<ord,field,value,source>>``) and ``found_all``.

    ``found_all`` is true when every requested field has a non-null value, and
    for an empty request. ``plans`` (from :func:`plan_table`) is joined by
    broadcast instead of evaluating the trigger cascades on every row; a frame
    that already carries ``_plan`` (from :func:`attach_plans`) is used as is.
    """
    if "_plan" in df.columns:
        out = df
    elif plans is None:
        out = df.withColumn("_plan", field_plan(F.col(label), F.col(fields), rules))
    else:
        out = attach_plans(df, plans, label=label, fields=fields, rules=rules)
    if "_needed" not in out.columns:
        out = out.withColumn("_needed", _needed(F.col("_plan"), rules))
    vals = F.array(*[extractor_value(rules.extractors[x], F.col(text), F.get(F.col("_needed"), F.lit(i)))
                     for x, i in rules.extractor_index.items()])
    out = (out
           .withColumn("_vals", vals)
           .withColumn("rule_values", F.transform(F.col("_plan"), lambda p: _field_value(p, F.col("_vals"))))
           .withColumn("found_all", F.forall("rule_values", lambda v: v["value"].isNotNull())))
    if keep_plan:
        out = out.withColumnRenamed("_plan", "plan")
    return out.drop("_plan", "_needed", "_vals", "_schema_hash")


def extractor_values(df: DataFrame, ids: list[str], *, text: str = "text",
                     rules: RuleSet = DEFAULT) -> DataFrame:
    """One column per named extractor, each regex evaluated once (rule-level reports)."""
    out = staged_values(df, text, None, ids, rules)
    return out.withColumnsRenamed({f"_v{rules.extractor_index[x]}": x for x in ids})

