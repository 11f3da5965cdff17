"""Coverage and saving statistics: per job, overall, and by document type.

The reported counts follow the reference's report, quirks included, and the
true counts sit next to them:

* ``heuristics`` / ``llm`` - as reported: when the metadata says rules were used
  and the fallback was not (all found, *or* the fallback failed), every
  requested field is counted as found by rules; a cache hit counts 0 and 0.
* ``rules_found`` - fields the rules really found; ``llm_found`` - fallback
  fields that came back non-null (``llm`` counts every field *asked* for).
* Error rows count in ``files`` and in the by-type field totals, not in the
  overall field totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _size0(arr: Column) -> Column:
    return F.when(arr.isNull(), F.lit(0)).otherwise(F.size(arr)).cast("long")


def _pct(num: Column, den: Column) -> Column:
    """``num / den * 100`` in double, 0 when ``den`` is 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")) * F.lit(100.0), F.lit(0.0))


def per_job(results: DataFrame) -> DataFrame:
    m = F.col("metadata")
    total = F.col("n_fields").cast("long")
    is_err = F.col("error_class").isNotNull()
    rules_only = m["heuristics_used"] & ~m["llm_used"]
    heur = F.when(is_err, F.lit(0).cast("long")).when(rules_only, total).otherwise(_size0(m["found_by_heuristics"]))
    llm = F.when(is_err | rules_only, F.lit(0).cast("long")).otherwise(_size0(m["found_by_llm"]))
    found = F.when(is_err, F.lit(0).cast("long")).otherwise(
        F.size(F.filter("result", lambda r: r["value"].isNotNull())).cast("long"))
    out = results.select(
        "job_id",
        F.replace(F.col("doc_id").cast("string"), F.lit("tela_sistema_"), F.lit("sistema_")).alias("file"),
        "label",
        total.alias("total_fields"),
        heur.alias("heuristics"),
        llm.alias("llm"),
        found.alias("found"),
        F.coalesce(m["cache_hit"], F.lit(False)).alias("cache_hit"),
        F.when(is_err, F.lit(0).cast("long")).otherwise(_size0(m["found_by_heuristics"])).alias("rules_found"),
        F.when(is_err, F.lit(0).cast("long")).otherwise(F.size(F.filter(
            "result", lambda r: r["source"] == F.lit("fallback"))).cast("long")).alias("llm_found"),
        F.col("error_message").alias("error"),
    )
    return (out
            .withColumn("missing", F.col("total_fields") - F.col("found"))
            .withColumn("coverage", F.when(F.col("error").isNotNull(), F.lit(0.0))
                        .otherwise(_pct(F.col("found"), F.col("total_fields"))))
            .withColumn("heuristics_coverage", F.when(F.col("error").isNotNull(), F.lit(0.0))
                        .otherwise(_pct(F.col("heuristics"), F.col("total_fields")))))


def shown(share: Column) -> Column:
    """A percentage as the report prints it: one decimal, half to even as Python rounds."""
    return F.format_string("%.1f", F.bround(share, 1))


def partials(per_job_df: DataFrame) -> DataFrame:
    """Sums per label, from which both reports follow; those of several batches are added up."""
    ok = F.col("error").isNull()

    def total(column: str, condition: Column | None = None) -> Column:
        value = F.col(column) if condition is None else F.when(condition, F.col(column))
        return F.coalesce(F.sum(value), F.lit(0)).cast("long")

    return per_job_df.groupBy("label").agg(
        F.count(F.lit(1)).alias("files"),
        total("total_fields").alias("total_fields"),
        total("total_fields", ok).alias("fields_read"),
        total("heuristics").alias("heuristics"),             # errors count none
        total("llm").alias("llm"),
        F.count_if(F.col("cache_hit")).cast("long").alias("cache_hits"),
        F.count_if(~F.col("cache_hit") & ok).cast("long").alias("cache_misses"),
    )


def overall(per_job_df: DataFrame) -> DataFrame:
    return overall_of(partials(per_job_df))


def by_type(per_job_df: DataFrame) -> DataFrame:
    return by_type_of(partials(per_job_df))


def overall_of(sums: DataFrame) -> DataFrame:
    """The report over all jobs, from rows of ``partials``."""
    names = {"files": "total_files", "fields_read": "total_fields", "heuristics": "total_heuristics", "llm": "total_llm",
             "cache_hits": "cache_hits", "cache_misses": "cache_misses"}
    agg = sums.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name) for c, name in names.items()])
    h, l, t = F.col("total_heuristics"), F.col("total_llm"), F.col("total_fields")
    has_llm = l > 0
    return agg.select(
        "*",
        _pct(h + l, t).alias("overall_coverage"),
        _pct(h, t).alias("heuristics_coverage"),
        _pct(l, t).alias("llm_pct"),
        F.when(has_llm, _pct(h, h + l)).alias("savings_pct"),
        F.when(has_llm, t.cast("double") / l.cast("double")).alias("reduction_factor"),
        F.when(has_llm, h).alias("calls_saved"),
    )


def by_type_of(sums: DataFrame) -> DataFrame:
    """The report by document type, from rows of ``partials``."""
    agg = sums.groupBy("label").agg(*[F.sum(c).cast("long").alias(c) for c in ("files", "total_fields", "heuristics", "llm")])
    return agg.select(
        "*",
        _pct(F.col("heuristics"), F.col("total_fields")).alias("heuristics_pct"),
        (F.try_divide(F.col("llm").cast("double"), F.col("total_fields").cast("double"))
         * F.lit(100.0)).alias("llm_pct"),
    )
