"""Full three-level extraction over a DataFrame of jobs.

A *job* is (job_id, label, requested fields, document); job ids are unique. The flow,
for all jobs at once:

1. **keys** (narrow): content hash, request hash and cache key of every job, and the
   errors known by then. A small table without text and request. The request's hash comes
   with the plan of its request, which is worked out once for each distinct one before.
2. **first writers** (one shuffle of fixed-width rows, pre-aggregated): the lowest
   ``job_id`` of each key computes; later jobs with the key are hits of its result.
3. **cache lookup** on the keys. A hit costs one hash: no rule sees its text.
4. **rules** on the jobs that compute. They are picked from the source by a broadcast
   of the fewer ids, those that compute or those that do not, if that is small. Else, where
   most jobs compute, the rules run on all of them; where many do not, a shuffle join picks
   them, before their text is put together. Text is kept only where a field stayed null, for
   the prompt.
5. **fallback**: request queue for keys with missing fields, caller's answers parsed
   and merged; only null fields are filled.
6. **fan-out**: every job gets its key's result through a salted join, so a key
   shared by a large share of the jobs is spread over many tasks.

Outputs: per-job results with metadata, new cache entries, the request queue,
and error rows (bad request, no document, no pages).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift import schema as S
from docsift.operators.engine import apply_rules, attach_plans, plan_table
from docsift.operators.rules import DEFAULT, RuleSet
from docsift.operators.fallback import (DEFAULT_MODEL, Fallback, answer_for, build_requests, json_string,
                                        parse_response, response_error)
from docsift.operators.skew import salted_join
from docsift.plans.partitioning import spread
from docsift.session import Scratch
from docsift.sources.files import ERR_SCHEMA, ERR_ZERO_PAGES

SOURCE_FALLBACK = "fallback"
ERR_NOT_FOUND = "FILE_NOT_FOUND"

ERROR_MESSAGES = {ERR_SCHEMA: "invalid request", ERR_NOT_FOUND: "document not found: ",
                  ERR_ZERO_PAGES: "document has 0 pages: "}

RESULT_FIELDS = "array<struct<field:string,value:string,source:string,raw:string>>"
BROADCAST_IDS = 1_000_000       # longs
MOST = 0.7                      # share of the jobs that compute, from which on the rules run on all
CacheLookup = Callable[[DataFrame], DataFrame | None]


@dataclass
class Extraction:
    results: DataFrame       # one row per job (errors included, with error_class set)
    new_cache: DataFrame     # cache rows for keys computed in this run
    requests: DataFrame      # fallback request queue (keys with missing fields)
    scratch: Scratch         # the tables that the three above read

    def cleanup(self) -> None:
        """Delete the intermediate tables, once the results are stored elsewhere."""
        self.scratch.remove()


def prepare_jobs(jobs: DataFrame, documents: DataFrame | None = None, *,
                 fields: str = "fields", request: str | None = None, dealt: bool = False) -> DataFrame:
    """Normalise jobs to ``job_id, doc_id, label, fields, text``.

    ``request`` names a ``map<string,string>`` column to turn into ordered fields.
    When ``documents(doc_id, text)`` is given it is joined on ``doc_id``; a job whose
    document is absent keeps a null text and becomes an error row. A column
    ``error_class`` (of request parsing or page reading) is kept. ``dealt``: the rows already lie on all cores,
    so texts are not moved to get there.
    """
    if request is not None:
        jobs = jobs.withColumn("fields", S.fields_of(F.col(request)))
    elif fields != "fields":
        jobs = jobs.withColumnRenamed(fields, "fields")
    if documents is not None:
        jobs = jobs.join(documents.select("doc_id", "text"), "doc_id", "left")
    known = ["error_class"] if "error_class" in jobs.columns else []
    out = jobs.select("job_id", "doc_id", "label", "fields", "text", *known)
    return out if dealt else spread(out)


def scan(jobs: DataFrame, *, key_includes_label: bool = False, plans: DataFrame | None = None,
         rules: RuleSet = DEFAULT) -> DataFrame:
    """Narrow pass over the text: errors and keys, one row per job, no text.

    ``plans`` (of all these jobs): the hash of a request is read from its plan instead of worked out for every job.
    """
    given = F.col("error_class") if "error_class" in jobs.columns else F.lit(None).cast("string")
    error = F.coalesce(given, F.when(F.col("fields").isNull(), F.lit(ERR_SCHEMA)),
                       F.when(F.col("text").isNull(), F.lit(ERR_NOT_FOUND)))
    content = S.content_hash(F.col("text"))
    if plans is None:
        request = S.schema_hash(F.col("fields"))
    else:
        jobs, request = attach_plans(jobs, plans.select("_family", "_fields", "_schema_hash"), rules=rules), F.col("_schema_hash")
    key = S.cache_key(F.col("content_hash"), F.col("schema_hash"), F.col("label") if key_includes_label else None)
    n_fields = F.when(F.col("fields").isNotNull(), F.size("fields")).otherwise(0)
    return (jobs.withColumn("error_class", error)
            .withColumn("content_hash", F.when(F.col("error_class").isNull(), content))
            .withColumn("schema_hash", F.when(F.col("error_class").isNull(), request))
            .select("job_id", "doc_id", "label", "error_class", "content_hash", "schema_hash",
                    F.when(F.col("error_class").isNull(), key).alias("cache_key"),
                    n_fields.cast("int").alias("n_fields")))


def _readable(jobs: DataFrame) -> Column:
    """The jobs without an error so far: they have a key."""
    given = F.col("error_class").isNull() if "error_class" in jobs.columns else F.lit(True)
    return given & F.col("fields").isNotNull() & F.col("text").isNotNull()


def _computing(jobs: DataFrame, scanned: DataFrame, ids: DataFrame) -> DataFrame:
    """The jobs whose ``job_id`` is in ``ids``, and maybe others that have a key too, moving no text where that pays.

    Few ids on either side of the choice go to the jobs as a broadcast. Where most readable jobs compute anyway, the
    rules run on all of these and what the others give is left out by the narrow joins that follow. Only where
    many compute, and many more do not, the jobs are shuffled.

    The ids that compute stand in an ``IN``: Spark takes a filter down to the rows that a text is put together from,
    but leaves a semi join above that, where the text of every job would be formed, and moved.
    """
    readable = jobs.filter(_readable(jobs)).drop("error_class")
    n, n_keyed = ids.count(), scanned.filter(F.col("error_class").isNull()).count()
    if n == 0:
        return readable.filter(F.lit(False))
    if n <= BROADCAST_IDS:
        return readable.filter(F.col("job_id").isin(F.broadcast(ids)))
    if n_keyed - n <= BROADCAST_IDS:
        rest = scanned.filter(F.col("error_class").isNull()).select("job_id").join(ids, "job_id", "left_anti")
        return readable.join(F.broadcast(rest), "job_id", "left_anti")
    if n >= MOST * n_keyed:
        return readable
    return readable.filter(F.col("job_id").isin(ids))


def _missing(rule_values: Column, fields: Column) -> Column:
    """Ordered sub-schema of the fields the rules left null."""
    names = F.transform(F.filter(rule_values, lambda v: v["value"].isNull()), lambda v: v["field"])
    return F.filter(fields, lambda f: F.array_contains(names, f["field"]))


def _names(values: Column, pred) -> Column:
    return F.transform(F.filter(values, pred), lambda v: v["field"])


def extract(jobs: DataFrame, *, cache: DataFrame | CacheLookup | None = None, fallback: Fallback | None = None,
            key_includes_label: bool = False, cache_partial: bool = True,
            hot_rows: int = 1_000_000, rows_per_salt: int | None = None,
            rules: RuleSet = DEFAULT, model: str = DEFAULT_MODEL, cache_too: bool = False,
            staged: bool = False) -> Extraction:
    """Run the three levels over ``jobs(job_id, doc_id, label, fields, text)``.

    ``cache``: existing cache rows (:data:`docsift.schema.CACHE`), or a function from the stored
    table of wanted keys to the rows that they need (:meth:`docsift.sources.cache.KeyedCache.lookup`).
    ``fallback``: caller's answerer for missing fields, or None (the fallback
    step then fails like a missing credential: rule results are kept).
    ``key_includes_label``: the reference keys on content and request only, so a
    second label with the same content and request gets the first label's result.
    ``cache_partial``: cache results whose fallback failed (reference behaviour).
    ``model``: name written into the requests.
    ``cache_too``: both ``results`` and ``new_cache`` will be read, so the merged results of the keys are stored
    instead of being formed for each.
    ``staged``: what the rules gave is stored under its keys before it meets answers and jobs. So the files of one
    shuffle lie on disk at a time, for one more table to write and read; texts stay where they are.
    """
    scratch = Scratch(jobs.sparkSession, lean=True)
    plans = plan_table(jobs, lambda df: scratch.table(df, "plans"), rules=rules)
    # keys are stored and shuffled as bytes, and are texts again where they leave
    scanned = scratch.table(
        scan(jobs, key_includes_label=key_includes_label, plans=plans, rules=rules).drop("content_hash", "schema_hash")
        .withColumn("cache_key", S.packed_key(F.col("cache_key"), formed=True)), "scan")
    ok = scanned.filter(F.col("error_class").isNull())

    # 2. the first job of each key: fixed-width aggregates, no payload
    keys = ok.groupBy("cache_key").agg(F.min("job_id").alias("first_job_id"), F.count(F.lit(1)).alias("n_jobs"))

    # 3. cache lookup: any row under the key is a hit, even an empty result
    as_text, as_bytes = S.unpacked_key(F.col("cache_key")), S.packed_key(F.col("cache_key"), formed=True)
    looked_up = cache is not None
    if looked_up:
        keys = keys.withColumn("cache_key", as_text)
    if callable(cache):
        keys = scratch.table(keys, "wanted")
        cache = cache(keys)
    if cache is not None:
        cached = cache.select("cache_key", F.col("result").cast(RESULT_FIELDS).alias("cached_result"),
                              F.lit(True).alias("in_cache"))
        keys = keys.join(cached, "cache_key", "left")
    else:
        keys = (keys.withColumn("cached_result", F.lit(None).cast(RESULT_FIELDS))
                .withColumn("in_cache", F.lit(None).cast("boolean")))
    if looked_up:
        keys = keys.withColumn("cache_key", as_bytes)
    keys = scratch.table(keys.withColumn("in_cache", F.coalesce(F.col("in_cache"), F.lit(False))), "keys")

    # 4. rules, only where a result has to be computed
    computing = keys.filter(~F.col("in_cache")).select(F.col("first_job_id").alias("job_id"))
    todo = _computing(jobs, scanned, computing)
    if plans is not None:
        todo = attach_plans(todo, plans, rules=rules)
    incomplete = ~F.col("found_all")
    ruled = apply_rules(todo, rules=rules).select(
        F.col("job_id").alias("first_job_id"), "doc_id", "label", "rule_values", "found_all",
        F.when(incomplete, _missing(F.col("rule_values"), F.col("fields"))).alias("missing"),
        F.when(incomplete, F.col("text")).alias("text"), F.monotonically_increasing_id().alias("ruled_row"))
    ruled = scratch.table(ruled, "ruled")
    keyed = keys.join(ruled.select(
        "first_job_id", "rule_values", "found_all", F.transform("missing", lambda f: f["field"]).alias("asked"), "ruled_row"),
        "first_job_id", "left")

    # 5. fallback for computed keys with missing fields
    needs = ~F.col("in_cache") & ~F.col("found_all")
    if staged:
        keyed = scratch.table(keyed, "keyed")
        scratch.remove("keys")
        counts, asking = keyed.select("cache_key", "n_jobs"), keyed.filter(needs).select("cache_key", "ruled_row")
        pending = ruled.join(asking, "ruled_row")
    else:
        counts, asking = keys, keys.filter(~F.col("in_cache")).select("cache_key", "first_job_id")
        pending = ruled.filter(incomplete).join(asking, "first_job_id")
    pending = pending.withColumn("request_id", as_text)
    requests = build_requests(pending.select("request_id", "doc_id", "label", "text", "missing"), model=model)
    if fallback is not None:
        # The fallback may be a paid external call: run it once, never on recomputation.
        answers = scratch.table(fallback(requests).select(
            S.packed_key(F.col("request_id")).alias("cache_key"), "response_json"), "answers")
        keyed = keyed.join(answers.withColumn("_answered", F.lit(True)), "cache_key", "left")
    else:
        keyed = (keyed.withColumn("response_json", F.lit(None).cast("string"))
                 .withColumn("_answered", F.lit(None).cast("boolean")))

    keyed = (keyed
             .withColumn("_parsed", parse_response(F.col("response_json")))
             .withColumn("llm_error", F.when(needs, response_error(
                 F.col("_answered").isNotNull(), F.col("response_json"), F.col("_parsed"),
                 fallback is not None))))
    llm_ok = needs & F.col("llm_error").isNull()

    def merge(v: Column) -> Column:
        answer = answer_for(F.col("_parsed"), v["field"])
        filled = v["value"].isNull() & llm_ok & answer.cast("string").isNotNull()
        return F.struct(
            v["field"].alias("field"),
            F.when(v["value"].isNotNull(), v["value"]).when(filled, answer.cast("string")).alias("value"),
            F.when(v["value"].isNotNull(), v["source"]).when(filled, F.lit(SOURCE_FALLBACK)).alias("source"),
            F.when(filled, F.to_json(answer)).alias("raw"))

    per_key = keyed.select(
        "cache_key", "n_jobs", "in_cache", "llm_error", "first_job_id",
        F.when(F.col("in_cache"), F.col("cached_result"))
         .otherwise(F.transform("rule_values", merge)).alias("result"),
        F.when(~F.col("in_cache"), _names(F.col("rule_values"), lambda v: v["value"].isNotNull())).alias("found_by_rules"),
        llm_ok.alias("llm_used"),
        F.when(llm_ok, F.col("asked")).alias("found_by_llm"),
    )
    if cache_too:
        per_key = scratch.table(per_key, "per_key")

    new_cache = per_key.filter(~F.col("in_cache"))
    if not cache_partial:
        new_cache = new_cache.filter(F.col("llm_error").isNull())
    hashes = F.split("cache_key", ":")
    new_cache = new_cache.withColumn("cache_key", as_text).select(
        "cache_key", hashes[0].alias("content_hash"), hashes[1].alias("schema_hash"),
        "result", F.current_timestamp().alias("created_at"))

    # 6. fan out: every job gets its key's result
    job_side = ok.select("job_id", "doc_id", "label", "n_fields", "cache_key")
    joined = salted_join(job_side, per_key, "cache_key", count_col="n_jobs", order_col="job_id",
                         hot_rows=hot_rows, rows_per_salt=rows_per_salt, counts=counts)
    hit = F.col("in_cache") | (F.col("job_id") != F.col("first_job_id"))
    metadata = F.struct(
        hit.alias("cache_hit"),
        (~hit).alias("heuristics_used"),
        (~hit & F.col("llm_used")).alias("llm_used"),
        F.when(~hit, F.col("found_by_rules")).alias("found_by_heuristics"),
        F.when(~hit, F.col("found_by_llm")).alias("found_by_llm"),
        F.when(~hit, F.col("llm_error")).alias("llm_error"),
        F.col("label").alias("label"),
    )
    results = joined.select("job_id", "doc_id", "label", "n_fields", as_text.alias("cache_key"), "result",
                            metadata.alias("metadata"),
                            F.lit(None).cast("string").alias("error_class"),
                            F.lit(None).cast("string").alias("error_message"))

    errors = scanned.filter(F.col("error_class").isNotNull()).select(
        "job_id", "doc_id", "label", "n_fields", F.lit(None).cast("string").alias("cache_key"),
        F.lit(None).cast(RESULT_FIELDS).alias("result"),
        F.lit(None).cast(results.schema["metadata"].dataType).alias("metadata"),
        "error_class", _error_message(F.col("error_class"), F.col("doc_id")).alias("error_message"))

    return Extraction(results=results.unionByName(errors), new_cache=new_cache, requests=requests, scratch=scratch)


def _error_message(error: Column, doc_id: Column) -> Column:
    out = error
    for known, text in ERROR_MESSAGES.items():
        message = F.concat(F.lit(text), doc_id.cast("string")) if text.endswith(" ") else F.lit(text)
        out = F.when(error == known, message).otherwise(out)
    return out


def result_json(result: Column) -> Column:
    """Compact JSON object of the result in request order: nulls and non-ASCII kept, fallback values with
    the type that they came in."""
    entries = F.transform(result, lambda r: F.concat(
        json_string(r["field"]), F.lit(":"), F.coalesce(r["raw"], json_string(r["value"]), F.lit("null"))))
    names = F.transform(result, lambda r: r["field"])
    # strings only, each name once: one map, written in one go
    plain = (F.forall(result, lambda r: r["field"].isNotNull() & r["raw"].isNull())
             & (F.size(F.array_distinct(names)) == F.size(result)))
    return F.when(plain, F.to_json(F.map_from_arrays(names, F.transform(result, lambda r: r["value"])))).otherwise(
        F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}")))


def result_long(results: DataFrame) -> DataFrame:
    """One row per (job, field): ``job_id, ord, field, value, source``."""
    # explode_outer + filter: see catalog.rules_documents (no inferred size() filter)
    return results.filter(F.col("error_class").isNull()).select(
        "job_id", F.posexplode_outer("result").alias("ord", "r")).filter(F.col("ord").isNotNull()).select(
        "job_id", F.col("ord").cast("int").alias("ord"), F.col("r.field").alias("field"),
        F.col("r.value").alias("value"), F.col("r.source").alias("source"))
