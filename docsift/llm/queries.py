"""The registered queries: each operator over its whole table, production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docsift.llm import alignment, decontamination, exact_dedup, fill_in_middle, jaccard_join, language_id, licenses
from docsift.llm import packing, quality_rules, substring_dedup, suffix_dedup
from docsift.llm import token_counts, token_files
from docsift.session import checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(_documents(spark, sf_dir)).drop("kept")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, sf_dir))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = jaccard_join.Rule(n=4, num=85, den=100)
    return jaccard_join.jaccard_components(_documents(spark, sf_dir), rule).select(
        "doc_id", "n_shingles", "component_id")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(_documents(spark, sf_dir)).drop("kept")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(_documents(spark, sf_dir))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        _documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return language_id.predict(docs, language_id.fit(docs))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    token_files.write(_documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.digests(spark, path)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        _documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.report(_documents(spark, sf_dir))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_documents(spark, sf_dir)).drop("distance")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


def queries() -> dict[str, Query]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_jaccard_join": op3_jaccard_join,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_decontamination": op5_decontamination,
        "op6_license_scan": op6_license_scan,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_language_id": op8_language_id,
        "op9_token_files": op9_token_files,
        "op10_token_counts": op10_token_counts,
        "op11_fill_in_middle": op11_fill_in_middle,
        "op12_quality_rules": op12_quality_rules,
        "op13_token_alignment": op13_token_alignment,
    }
