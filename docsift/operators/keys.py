"""Counting the cache keys of documents and requests without forming them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_keys(contents: DataFrame, requests: DataFrame, by: str) -> DataFrame:
    """``by, n_contents, n_schemas, n_keys``: how many cache keys all documents of a group have with all its requests.

    ``contents(by, content_hash)``, ``requests(by, schema_hash)``. A key is a content and a request, so the distinct keys of
    a group are its distinct contents times its distinct requests: each side is counted by itself, and only the counts
    meet, by the group. Documents and requests are never paired.
    """
    def distinct(df: DataFrame, column: str, name: str) -> DataFrame:
        # distinct rows first: a group with a third of all rows is counted by many tasks
        return df.select(by, column).distinct().groupBy(by).agg(F.count(column).alias(name))

    return (distinct(contents, "content_hash", "n_contents").join(distinct(requests, "schema_hash", "n_schemas"), by)
            .withColumn("n_keys", F.col("n_contents") * F.col("n_schemas")))
