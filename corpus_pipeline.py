"""The corpus pipeline: language ID, exact dedup, n-gram Jaccard join, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``. Every stage works on all rows its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docsift.llm import decontamination, exact_dedup, jaccard_join, language_id, packing
from docsift.session import materialize

LEAST_SCORE = 0.3            # below it no language stands out of the four


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those of no recognisable language."""
    return language_id.keep_languages(docs, language_id.fit(docs), LEAST_SCORE)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words and a similarity of 0.8."""
    return jaccard_join.one_of_each(docs, jaccard_join.Rule(n=5, num=4, den=5))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects contaminated documents."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("jaccard_join", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL cannot express the recurrent network; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
