"""Registered queries: one per operator of the survey's inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the driver's
tables, or over documents Spark derives from them (:mod:`docsift.sources.tables`),
so its work grows with the tables. The matching DuckDB SQL lives in
:mod:`docsift.oracle_sql` under the same name and produces the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift import schema as S
from docsift.operators import stats
from docsift.operators.engine import apply_rules, extractor_values, plan_table
from docsift.operators.extract import Extraction, extract, prepare_jobs, result_json, result_long
from docsift.operators.keys import distinct_keys
from docsift.operators.workers import by_workers
from docsift.plans.partitioning import spread
from docsift.plans.rule_plan import field_plan
from docsift.session import materialize
from docsift.sources import files, ledger
from docsift.sources import tables as T
from docsift.sources.cache import KeyedCache
from docsift.sources.sinks import read_results_in_order, write_results_in_order
from docsift.streaming.dedup import first_arrivals
from docsift.streaming.incremental import (append_cache, clear_cache, extract_stream, new_store, read_cache, read_report,
                                           read_results, run_batch)

Query = Callable[[SparkSession, str], DataFrame]

# rule query name -> (fixture, extractor id)
RULE_QUERIES: dict[str, tuple[str, str]] = {
    "rules_oab_nome": ("cards", "oab_nome"),
    "rules_oab_inscricao": ("cards", "oab_inscricao"),
    "rules_oab_seccional": ("cards", "oab_seccional"),
    "rules_oab_subsecao": ("cards", "oab_subsecao"),
    "rules_oab_categoria": ("cards", "oab_categoria"),
    "rules_oab_endereco": ("cards", "oab_endereco"),
    "rules_oab_telefone": ("cards", "telefone"),
    "rules_oab_situacao": ("cards", "oab_situacao"),
    "rules_sistema_cidade": ("screens", "sis_cidade"),
    "rules_sistema_pesquisa_por": ("screens", "sis_pesquisa_por"),
    "rules_sistema_pesquisa_tipo": ("screens", "sis_pesquisa_tipo"),
    "rules_sistema_produto": ("screens", "sis_produto"),
    "rules_sistema_quantidade_parcelas": ("screens", "sis_quantidade_parcelas"),
    "rules_sistema_selecao_parcelas": ("screens", "sis_selecao_parcelas"),
    "rules_sistema_sistema": ("screens", "sis_sistema"),
    "rules_sistema_tipo_operacao": ("screens", "sis_tipo_operacao"),
    "rules_sistema_tipo_sistema": ("screens", "sis_tipo_sistema"),
    "rules_sistema_total_parcelas": ("screens", "sis_total_parcelas"),
    "rules_sistema_valor_parcela": ("screens", "sis_valor_parcela"),
    "rules_generic_cpf": ("both", "gen_cpf"),
    "rules_generic_telefone": ("both", "telefone"),
    "rules_generic_data": ("both", "gen_data"),
}


def fixture_docs(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    if which == "cards":
        return T.cards(spark, sf_dir)
    if which == "screens":
        return T.screens(spark, sf_dir)
    return T.cards(spark, sf_dir).unionByName(T.screens(spark, sf_dir))


def fixture_fallback(requests: DataFrame) -> DataFrame:
    """Deterministic stand-in for a model service, keyed on the request's document.

    ``doc_id % 10 == 9`` answers malformed JSON, ``== 8`` a JSON array (both are
    fallback errors); ``== 7`` leaves out the first asked field; every answer
    adds an unasked key. Values: the document id as a JSON number when
    ``doc_id % 3 == 0``, else the string ``<field>-<doc_id>``.
    """
    d = F.col("doc_id")
    names = F.transform("missing", lambda f: f["field"])
    asked = F.when(F.pmod(d, F.lit(10)) == 7, F.slice(names, 2, F.greatest(F.size(names) - 1, F.lit(0)))) \
        .otherwise(names)
    value = lambda f: F.when(F.pmod(d, F.lit(3)) == 0, d.cast("string")).otherwise(
        F.concat(F.lit('"'), f, F.lit("-"), d.cast("string"), F.lit('"')))
    pairs = F.transform(asked, lambda f: F.concat(F.lit('"'), f, F.lit('": '), value(f)))
    obj = F.concat(F.lit("{"), F.array_join(F.concat(pairs, F.array(F.lit('"extra_key": true'))), ", "),
                   F.lit("}"))
    body = (F.when(F.pmod(d, F.lit(10)) == 9, F.lit('{"broken": '))
            .when(F.pmod(d, F.lit(10)) == 8, F.lit('["not", "an", "object"]'))
            .otherwise(obj))
    return requests.select("request_id", body.alias("response_json"))


def _rule_query(which: str, x: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        d = fixture_docs(spark, sf_dir, which).select("doc_id", "text")
        return extractor_values(d, [x]).select("doc_id", F.col(x).alias("value"))
    return q


def rules_long_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules with repeated groups on runs of up to 3,900 capital words (one text per customer)."""
    c = spread(T.load(spark, sf_dir, "customer").select("c_custkey"))      # the keys are dealt, not the texts
    words = F.pmod(F.col("c_custkey") * 97, F.lit(40)) * 50 + 1
    run = F.concat(F.lit("nome "), F.repeat(F.lit("JOAO SILVA "), words.cast("int")), F.lit("fim\nProduto "),
                   F.repeat(F.lit("CREDITO "), words.cast("int")), F.lit("Qtd 1"))
    d = c.select(F.col("c_custkey").alias("doc_id"), run.alias("text"))
    out = extractor_values(d, ["oab_nome", "sis_produto"])
    return out.select("doc_id", F.length("oab_nome").alias("n_nome"), F.sha2("oab_nome", 256).alias("nome_sha256"),
                      F.length("sis_produto").alias("n_produto"))


#: What stands between the parts of a text in ``rules_unicode``, picked by document.
UNICODE_SIGNS = ("\u0301", "\u00b2", "\u00bd", "\x1c", "\u00a0", "_", "\u00d7", "\u2028", "-")


def rules_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and numbers beside signs on which regex dialects differ (one text per customer)."""
    c = T.load(spark, sf_dir, "customer").select("c_custkey")
    sign = F.element_at(F.array(*[F.lit(s) for s in UNICODE_SIGNS]),
                        (F.pmod("c_custkey", F.lit(len(UNICODE_SIGNS))) + 1).cast("int"))
    text = F.concat(F.lit("123456"), sign, F.lit(" 654321 JOS"), sign, F.lit("E"), sign, F.lit("SILVA"))
    out = extractor_values(c.select(F.col("c_custkey").alias("doc_id"), text.alias("text")),
                           ["oab_nome", "oab_inscricao"])
    return out.select("doc_id", F.col("oab_nome").alias("nome"), F.col("oab_inscricao").alias("inscricao"))


def fixture_extraction(spark: SparkSession, sf_dir: str, *, staged: bool = False) -> Extraction:
    """Three-level extraction of all cards and screens, answered by the fixture fallback."""
    jobs = prepare_jobs(fixture_docs(spark, sf_dir, "both"), request="request", dealt=True)
    return extract(jobs, fallback=fixture_fallback, staged=staged)


def extract_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_long(fixture_extraction(spark, sf_dir).results)


def extract_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = fixture_extraction(spark, sf_dir).results
    m = F.col("metadata")
    return r.select(
        "job_id", "label",
        m["cache_hit"].alias("cache_hit"), m["heuristics_used"].alias("heuristics_used"),
        m["llm_used"].alias("llm_used"), m["llm_error"].alias("llm_error"),
        F.array_join(m["found_by_heuristics"], ",").alias("found_by_heuristics"),
        F.array_join(m["found_by_llm"], ",").alias("found_by_llm"))


def result_json_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = fixture_extraction(spark, sf_dir).results
    return r.select("job_id", result_json(F.col("result")).alias("result_json"))


def extract_found_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule level only: per job, how many fields the rules found and whether all were found."""
    jobs = prepare_jobs(fixture_docs(spark, sf_dir, "both"), request="request", dealt=True)
    ruled = apply_rules(jobs, plans=plan_table(jobs, lambda plans: materialize(plans, "plans")))
    return ruled.select(
        "job_id", "found_all",
        F.size("fields").cast("long").alias("n_fields"),
        F.size(F.filter("rule_values", lambda v: v["value"].isNotNull())).cast("long").alias("n_found"),
        F.size(F.filter("rule_values", lambda v: v["source"] == "generic_rules")).cast("long").alias("n_generic"))


def missing_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = prepare_jobs(fixture_docs(spark, sf_dir, "both"), request="request", dealt=True)
    return extract(jobs).requests.select(
        "doc_id", "label",
        F.array_join(F.transform("missing", lambda f: f["field"]), ",").alias("missing_fields"),
        F.sha2(F.col("prompt"), 256).alias("prompt_sha256"),
        F.col("request.model").alias("model"),
        F.size("request.messages").cast("long").alias("n_messages"))


def _fixture_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.per_job(fixture_extraction(spark, sf_dir).results)


def stats_per_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fixture_stats(spark, sf_dir).select(
        "job_id", "file", "label", "total_fields", "heuristics", "llm", "found", "missing", "coverage",
        "heuristics_coverage", stats.shown(F.col("coverage")).alias("coverage_shown"), "rules_found", "llm_found")


def stats_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.overall(_fixture_stats(spark, sf_dir))


def stats_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.by_type(_fixture_stats(spark, sf_dir))


def _all_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every job of every source: cards, screens and the driver documents."""
    cols = ["job_id", "doc_id", "label", "request"]
    fixtures = fixture_docs(spark, sf_dir, "both").select(*cols, F.lit("fixtures").alias("source"))
    docs = T.documents_jobs(spark, sf_dir).select(*cols, F.lit("documents").alias("source"))
    return fixtures.unionByName(docs)


def rule_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rule owns each distinct (label, field, description) requested anywhere."""
    fields = (_all_jobs(spark, sf_dir)
              .select("label", F.explode(S.fields_of(F.col("request"))).alias("f"))
              .select("label", F.col("f.field").alias("field"), F.col("f.description").alias("description"))
              .distinct())
    planned = fields.select("label", F.explode(field_plan(
        F.col("label"), F.array(F.struct(F.lit(0).alias("ord"), F.col("field").alias("field"),
                                         F.col("description").alias("description"))))).alias("p"))
    return planned.select("label", F.col("p.field").alias("field"), F.col("p.description").alias("description"),
                          F.col("p.label_rule").alias("label_rule"), F.col("p.generic_rule").alias("generic_rule"))


def manifest_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct requested field names over all jobs, with how many jobs ask for each."""
    return (_all_jobs(spark, sf_dir)
            .select(F.explode(F.map_keys("request")).alias("field"))
            .groupBy("field").agg(F.count(F.lit(1)).alias("n_jobs")))


def labels_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs per label, distinct field sets per label; labels with more than one job."""
    j = _all_jobs(spark, sf_dir).withColumn("field_set", F.array_join(F.array_sort(F.map_keys("request")), ","))
    return (j.groupBy("label")
            .agg(F.count(F.lit(1)).alias("n_jobs"), F.countDistinct("field_set").alias("n_field_sets"))
            .filter(F.col("n_jobs") > 1))


def _documents_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = prepare_jobs(T.documents_jobs(spark, sf_dir), request="request", dealt=True)
    return (jobs.withColumn("content_hash", S.content_hash(F.col("text")))
            .withColumn("schema_hash", S.schema_hash(F.col("fields")))
            .withColumn("cache_key", S.cache_key(F.col("content_hash"), F.col("schema_hash"))))


def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = T.load(spark, sf_dir, "documents")
    return d.select("doc_id", S.content_hash(F.col("text")).alias("content_hash"))


def cache_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents_keyed(spark, sf_dir).select("job_id", "schema_hash", "cache_key")


def schema_key_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every job's request hashed as given and reversed: the two hashes must agree."""
    jobs = _all_jobs(spark, sf_dir).withColumn("fields", S.fields_of(F.col("request")))
    return jobs.select(
        "source", "job_id",
        (S.schema_hash(F.col("fields")) == S.schema_hash(F.reverse("fields"))).alias("order_free"),
        F.size("fields").cast("long").alias("n_fields"))


def _documents_run(spark: SparkSession, sf_dir: str, cache, jobs: DataFrame) -> Extraction:
    return extract(prepare_jobs(jobs, request="request", dealt=True), cache=cache, fallback=fixture_fallback)


def _second_run(spark: SparkSession, sf_dir: str) -> Extraction:
    """Run 1 over the English documents builds a cache bucketed by key; run 2 looks all documents up in it."""
    jobs = T.documents_jobs(spark, sf_dir)
    cache = KeyedCache(spark, new_store(spark, "cache"))
    first = _documents_run(spark, sf_dir, None, jobs.filter(F.col("lang") == "en").drop("lang"))
    cache.append(first.new_cache)
    first.cleanup()
    return _documents_run(spark, sf_dir, cache.lookup(), jobs.drop("lang"))


def cache_first_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single run over all documents: the lowest job id of each key computes."""
    ex = _documents_run(spark, sf_dir, None, T.documents_jobs(spark, sf_dir).drop("lang"))
    return ex.results.select("job_id", F.col("metadata.cache_hit").alias("cache_hit"))


def cache_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    ex = _second_run(spark, sf_dir)
    return ex.results.select("job_id", F.col("metadata.cache_hit").alias("cache_hit"),
                             F.col("metadata.heuristics_used").alias("heuristics_used"))


def cache_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit / miss counts of the second run and the cache rows it appends (long form)."""
    ex = _second_run(spark, sf_dir)
    hits = ex.results.agg(
        F.count_if(F.col("metadata.cache_hit")).cast("long").alias("hits"),
        F.count_if(~F.col("metadata.cache_hit")).cast("long").alias("misses"),
        F.countDistinct("cache_key").cast("long").alias("distinct_keys"))
    added = ex.new_cache.agg(F.count(F.lit(1)).cast("long").alias("new_cache_rows"))
    return (hits.select(F.expr("stack(3, 'hits', hits, 'misses', misses, 'distinct_keys', distinct_keys)")
                        .alias("metric", "value"))
            .unionByName(added.select(F.lit("new_cache_rows").alias("metric"),
                                      F.col("new_cache_rows").alias("value"))))


def first_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = T.load(spark, sf_dir, "conversations")
    return files.first_page(pages, doc="conv_id", page="turn", text="text").select(
        F.col("conv_id"), F.col("text").alias("first_text"))


def zero_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = T.load(spark, sf_dir, "documents").select(F.col("doc_id").alias("conv_id"))
    pages = T.load(spark, sf_dir, "conversations")
    return files.zero_page_errors(docs, pages, doc="conv_id")


def jobs_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs over the driver documents written as JSON lines and read back (explicit schema)."""
    path = new_store(spark, "jobs")
    (T.documents_jobs(spark, sf_dir)
     .select("job_id", "label", F.col("request").alias("extraction_schema"),
             F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("pdf_path"))
     .write.json(path))
    jobs = files.read_jobs(spark, path)
    return jobs.select("job_id", "label", F.size("fields").cast("long").alias("n_fields"),
                       F.array_join(F.transform("fields", lambda f: f["field"]), ",").alias("field_names"),
                       F.col("doc_id").alias("pdf_path"))


def request_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request strings per document: whole, cut off, single-quoted, or with something after the object."""
    d = T.documents_jobs(spark, sf_dir)
    text, kind = F.to_json("request"), F.pmod(F.col("doc_id"), F.lit(13))
    raw = (F.when(kind == 0, F.expr("substring(to_json(request), 1, 20)"))
           .when(kind == 1, F.lit("{'a': 'x'}"))
           .when(kind == 2, F.concat(text, F.lit(" trailing")))
           .when(kind == 3, F.concat(text, F.lit(" "), text))
           .when(kind == 4, F.concat(F.lit("["), text, F.lit("]")))
           .otherwise(F.concat(F.lit(" "), text)))
    fields, err = files.parse_request(raw)
    n = F.when(fields.isNotNull(), F.size(fields))      # size(NULL) is -1 when ANSI mode is off
    return d.select("job_id", n.cast("long").alias("n_fields"), err.alias("error_class"))


def _faulty_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs on the driver documents with a cut request, no document, no pages or an empty request now and then."""
    d = T.documents_jobs(spark, sf_dir)
    kind = F.pmod(F.col("doc_id"), F.lit(11))
    raw = F.when(kind == 0, F.lit("{bad")).when(kind == 3, F.lit("{}")).otherwise(F.to_json("request"))
    fields, error = files.parse_request(raw)
    given = F.coalesce(error, F.when(kind == 2, F.lit(files.ERR_ZERO_PAGES)))
    return d.select("job_id", "doc_id", "label", fields.alias("fields"),
                    F.when(kind != 1, F.col("text")).alias("text"), given.alias("error_class"))


def extract_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every job's error, if any, and its field counts in the report; bad requests never reach the cache."""
    run = extract(prepare_jobs(_faulty_jobs(spark, sf_dir), dealt=True), fallback=fixture_fallback)
    report = stats.per_job(run.results).select("job_id", "total_fields", "error")
    return run.results.select("job_id", "error_class", F.col("cache_key").isNotNull().alias("keyed")).join(
        report, "job_id")


def empty_result_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second run over all faulty jobs: every result is a hit, one without fields too; errors stay errors."""
    jobs = prepare_jobs(_faulty_jobs(spark, sf_dir), dealt=True)
    cache = KeyedCache(spark, new_store(spark, "cache"))
    first = extract(jobs)
    cache.append(first.new_cache)
    first.cleanup()
    again = extract(jobs, cache=cache.lookup())
    n_fields = F.when(F.col("result").isNotNull(), F.size("result"))
    return again.results.select("job_id", "error_class", F.col("metadata.cache_hit").alias("cache_hit"),
                                n_fields.cast("long").alias("n_fields"))


def jobs_to_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs joined to their documents by id; every 17th job names a document that is not there."""
    d = T.documents_jobs(spark, sf_dir)
    jobs = d.select("job_id", F.when(F.pmod("doc_id", F.lit(17)) == 0, -F.col("doc_id") - 1)
                    .otherwise(F.col("doc_id")).alias("doc_id"), "label", "request")
    out = prepare_jobs(jobs, d.select("doc_id", "text"), request="request")
    return out.select("job_id", "doc_id", F.length("text").cast("long").alias("n_chars"))


def manifest_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs on the driver documents written as one JSON array, an entry a line over many files, and read back."""
    path = new_store(spark, "manifest")
    entry = F.to_json(F.struct("label", F.col("request").alias("extraction_schema"),
                               F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("pdf_path")))
    jobs = materialize(T.documents_jobs(spark, sf_dir).select(
        "job_id", entry.alias("entry"), F.monotonically_increasing_id().alias("at")), "entries")
    order = [F.col("job_id").asc_nulls_last(), F.col("at")]
    place = F.struct(F.col("job_id").isNull(), "job_id", "at")
    ends = jobs.agg(F.min_by("at", place).alias("first"), F.max_by("at", place).alias("last")).first()
    start = F.when(F.col("at") == ends["first"], F.lit("[")).otherwise(F.lit(""))
    end = F.when(F.col("at") == ends["last"], F.lit("]")).otherwise(F.lit(","))
    lines = jobs.orderBy(*order).select(F.concat(start, "entry", end).alias("value"))
    if ends["first"] is None:
        lines = spark.range(1).select(F.lit("[]").alias("value"))
    lines.write.text(path)
    return files.read_manifest(spark, path).select(
        "job_id", "label", F.size("fields").cast("long").alias("n_fields"), F.col("doc_id").alias("pdf_path"))


FILE_DOCS = 50


def _document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file, content``: the whole texts of ``FILE_DOCS`` neighbouring documents, a line end after each."""
    texts = F.array_sort(F.collect_list(F.struct("doc_id", F.coalesce("text", F.lit("")).alias("text"))))
    body = F.array_join(F.transform(texts, lambda t: F.concat(t["text"], F.lit("\n"))), "")
    return (T.load(spark, sf_dir, "documents").groupBy(F.floor(F.col("doc_id") / FILE_DOCS).alias("file"))
            .agg(body.cast("binary").alias("content")))


def _named(files: DataFrame) -> DataFrame:
    return files.select(F.concat(F.lit("docs-"), F.col("file").cast("string"), F.lit(".txt")).alias("name"), "content")


def _file_number() -> Column:
    return F.regexp_extract("path", r"docs-(\d+)\.txt$", 1).cast("long").alias("file")


def file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as files that arrive in two batches: the second run of the ledger hashes only the new ones."""
    store = new_store(spark, "files")
    given, table = materialize(_document_files(spark, sf_dir), "files"), ledger.Ledger(spark, f"{store}/ledger")
    for run in range(2):
        ledger.write_files(_named(given.filter(F.pmod("file", F.lit(2)) == run)), f"{store}/in")
        table.update(run, f"{store}/in", glob="*.txt")
    return table.rows().select(_file_number(), "length", "content_hash", "run_id")


def file_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files through a stream over ``binaryFile``, started again after the second half has arrived."""
    store = new_store(spark, "files")
    given = materialize(_document_files(spark, sf_dir), "files")
    for run in range(2):
        ledger.write_files(_named(given.filter(F.pmod("file", F.lit(2)) == run)), f"{store}/in")
        ledger.stream_files(spark, f"{store}/in", store, glob="*.txt").awaitTermination()
    return ledger.streamed_files(spark, store).select(_file_number(), "length", "content_hash")


def nested_request_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A description that is a JSON object hashes the same in any key order, and not with another value."""
    k = F.col("doc_id").cast("string")
    field = lambda d: S.schema_hash(F.array(F.struct(
        F.lit(0).alias("ord"), F.lit("f").alias("field"), d.alias("description"))))
    a = F.concat(F.lit('{"a": "'), k, F.lit('", "b": "y"}'))
    b = F.concat(F.lit('{"b": "y", "a": "'), k, F.lit('"}'))
    c = F.concat(F.lit('{"b": "z", "a": "'), k, F.lit('"}'))
    return T.load(spark, sf_dir, "documents").select(
        "doc_id", (field(a) == field(b)).alias("same"), (field(a) == field(c)).alias("other"))


def cache_keys_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct cache keys of all documents of a label with all requests of the label."""
    keyed = _documents_keyed(spark, sf_dir)
    schema_hash = S.schema_hash(S.fields_of(F.col("request"))).alias("schema_hash")
    return distinct_keys(keyed.select("label", "content_hash"), _all_jobs(spark, sf_dir).select("label", schema_hash), "label")


_calls: dict[str, int] = {}


def flaky_client(request: dict) -> str:
    """Deterministic stand-in for a model service: of four documents, one is answered at the first call, one at the
    second, one at the third, and one never."""
    key = request["request_id"]
    _calls[key] = _calls.get(key, 0) + 1
    if _calls[key] <= request["doc_id"] % 4:
        raise ConnectionError("the service is busy")
    del _calls[key]
    return f'{{"doc_id": {request["doc_id"]}, "prompt_chars": {len(request["prompt"])}}}'


def fallback_workers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All requests of cards and screens asked by four clients that fail now and then, in at most three calls each."""
    jobs = prepare_jobs(fixture_docs(spark, sf_dir, "both"), request="request", dealt=True)
    requests = materialize(extract(jobs).requests, "requests")
    ask = by_workers(flaky_client, new_store(spark, "answers"), clients=4, attempts=3, wait=0.001, log_every=500)
    return requests.select("request_id", "doc_id").join(ask(requests), "request_id", "left").select(
        "doc_id", "attempts", "response_json")


def results_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results written as JSON lines in manifest order and read back with their places."""
    path = new_store(spark, "ordered")
    run = fixture_extraction(spark, sf_dir, staged=True)
    write_results_in_order(run.results, path, compression="gzip", stored=run.cleanup)
    lines = read_results_in_order(spark, path)
    return lines.select("position", F.get_json_object("line", "$.job_id").cast("long").alias("job_id"),
                        F.get_json_object("line", "$.result_json").alias("result_json"))


def manifest_indented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The jobs' manifest as one array with an entry over many lines, written by many tasks and read by many."""
    path = new_store(spark, "manifest")
    entry = F.to_json(F.struct("label", F.col("request").alias("extraction_schema"),
                               F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("pdf_path")), {"pretty": "true"})
    jobs = T.documents_jobs(spark, sf_dir).select("job_id", F.concat(F.lit("\n"), entry).alias("entry"))
    first = jobs.agg(F.min("job_id")).first()[0]
    lines = jobs.repartitionByRange(4, "job_id").sortWithinPartitions("job_id").select(
        F.concat(F.when(F.col("job_id") == first, F.lit("[")).otherwise(F.lit(",")), "entry").alias("value"))
    lines.write.text(path)
    spark.createDataFrame([("]" if first is not None else "[]",)], "value string").coalesce(1).write.text(f"{path}_end")
    return files.read_manifest(spark, [path, f"{path}_end"]).select(
        "job_id", "label", F.size("fields").cast("long").alias("n_fields"), F.col("doc_id").alias("pdf_path"))


def cache_cleared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a stored cache before and after it is cleared."""
    path = new_store(spark, "cache")
    run = _documents_run(spark, sf_dir, None, T.documents_jobs(spark, sf_dir).drop("lang"))
    append_cache(run.new_cache, path)
    before = read_cache(spark, path).count()
    clear_cache(spark, path)
    after = read_cache(spark, path).agg(F.count(F.lit(1)).alias("n_rows"))
    return after.select(F.lit("after").alias("state"), "n_rows").unionByName(
        spark.range(1).select(F.lit("before").alias("state"), F.lit(before).cast("bigint").alias("n_rows")))


def custom_bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document type of the caller's own: a bank for labels with ``relatorio``, passed as ``rules=``."""
    from docsift.operators.rules import DEFAULT
    from docsift.operators.rules.bank import Alt, Extractor, Rule, RuleBank, name_has_any

    bank = RuleBank("relatorio", "relatorio", (Rule("palavra", name_has_any("palavra"), "first_word"),))
    rules = DEFAULT.with_bank(bank, {"first_word": Extractor((Alt(r"([A-Za-z]+)"),))})
    jobs = T.load(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("job_id"), "doc_id", F.lit("relatorio_mensal").alias("label"),
        F.create_map(F.lit("palavra"), F.lit("first word")).alias("request"), "text")
    return result_long(extract(prepare_jobs(jobs, request="request"), rules=rules).results)


def _streamed(spark: SparkSession, sf_dir: str) -> str:
    """Cards and screens arriving in four parts, extracted micro-batch by micro-batch; the folder of the results.

    A part is as many files as there are cores, so that each batch is written and read by all of them.
    """
    store, files_a_part = new_store(spark), spark.sparkContext.defaultParallelism
    jobs = prepare_jobs(fixture_docs(spark, sf_dir, "both"), request="request", dealt=True)
    jobs.repartition(4 * files_a_part, "job_id").write.parquet(f"{store}/incoming")
    stream = spark.readStream.schema(jobs.schema).option("maxFilesPerTrigger", files_a_part).parquet(f"{store}/incoming")
    query = extract_stream(stream, store=f"{store}/out", fallback=fixture_fallback)
    query.awaitTermination()
    return f"{store}/out"


def stream_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards and screens arriving in four parts, extracted micro-batch by micro-batch.

    Same rows as ``extract_long``: every fixture text is distinct, so arrival order
    cannot change which job is a key's first writer.
    """
    return result_long(read_results(spark, _streamed(spark, sf_dir)).drop("batch_id"))


def stream_report_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overall report after four micro-batches, from the sums kept of each."""
    return stats.overall_of(read_report(spark, _streamed(spark, sf_dir)))


def stream_report_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report by document type after four micro-batches, from the sums kept of each."""
    return stats.by_type_of(read_report(spark, _streamed(spark, sf_dir)))


def stream_first_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive week by week, those of the week before once more: each is let through once."""
    store = new_store(spark, "arrivals")
    events = T.load(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    week = F.floor(F.unix_seconds("ts") / F.lit(7 * 86400))
    weeks = materialize(events.withColumn("week", week), "weeks")
    first, last = weeks.agg(F.min("week"), F.max("week")).first()
    for w in range(first or 0, (last if last is not None else -1) + 1):
        (weeks.filter(F.col("week").isin(w - 1, w)).drop("week").repartition(2, "event_id")
         .write.mode("append").parquet(f"{store}/incoming"))
    weeks.filter(F.lit(False)).drop("week").write.mode("append").parquet(f"{store}/incoming")     # where there are no events
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{store}/incoming")
    query = (first_arrivals(stream, ["event_id"], "ts", "14 days").writeStream.format("parquet")
             .option("checkpointLocation", f"{store}/_checkpoint").trigger(availableNow=True).start(f"{store}/out"))
    query.awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{store}/out").select("event_id", "user_id", "event_type")


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first micro-batch run twice, as after a failure: its rows must be those of the first run."""
    store = new_store(spark)
    jobs = prepare_jobs(T.documents_jobs(spark, sf_dir).drop("lang"), request="request", dealt=True)
    for _ in range(2):
        run_batch(jobs, 0, store=store, fallback=fixture_fallback)
    r = read_results(spark, store)
    return r.select("job_id", F.col("metadata.cache_hit").alias("cache_hit"),
                    F.col("metadata.found_by_heuristics").isNull().alias("no_rules"))


def rules_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both rule banks over every driver document, whole texts."""
    jobs = prepare_jobs(T.documents_jobs(spark, sf_dir), request="request", dealt=True)
    ruled = apply_rules(jobs.select("job_id", "label", "fields", "text"))
    # explode_outer: a plain explode makes Catalyst infer size(rule_values) > 0 and push
    # it below the projections, re-running every extractor once per field.
    return (ruled.select("job_id", F.posexplode_outer("rule_values").alias("ord", "v"))
            .filter(F.col("ord").isNotNull())
            .select("job_id", F.col("ord").cast("long").alias("ord"), F.col("v.field").alias("field"),
                    F.col("v.value").alias("value"), F.col("v.source").alias("source")))


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {name: _rule_query(w, x) for name, (w, x) in RULE_QUERIES.items()}
    out.update({
        "rule_plan": rule_plan,
        "extract_found_all": extract_found_all,
        "extract_long": extract_long,
        "extract_jobs": extract_jobs,
        "result_json": result_json_q,
        "missing_requests": missing_requests,
        "stats_per_doc": stats_per_doc,
        "stats_overall": stats_overall,
        "stats_by_type": stats_by_type,
        "manifest_fields": manifest_fields,
        "labels_multi": labels_multi,
        "content_hash": content_hash,
        "cache_key": cache_key,
        "schema_key_order": schema_key_order,
        "cache_first_writer": cache_first_writer,
        "cache_split": cache_split,
        "cache_stats": cache_stats,
        "first_page": first_page,
        "zero_pages": zero_pages,
        "rules_documents": rules_documents,
        "stream_extract": stream_extract,
        "jobs_jsonl": jobs_jsonl,
        "request_parse": request_parse,
        "rules_long_runs": rules_long_runs,
        "rules_unicode": rules_unicode,
        "extract_errors": extract_errors,
        "empty_result_hit": empty_result_hit,
        "jobs_to_documents": jobs_to_documents,
        "manifest_jobs": manifest_jobs,
        "file_ledger": file_ledger,
        "nested_request_hash": nested_request_hash,
        "cache_cleared": cache_cleared,
        "custom_bank": custom_bank,
        "stream_replay": stream_replay,
        "stream_report_overall": stream_report_overall,
        "stream_report_by_type": stream_report_by_type,
        "stream_first_arrivals": stream_first_arrivals,
        "file_stream": file_stream,
        "cache_keys_of_all": cache_keys_of_all,
        "fallback_workers": fallback_workers,
        "results_in_order": results_in_order,
        "manifest_indented": manifest_indented,
    })
    return out
