"""Connected components of an edge table by minimum labels and pointer jumping, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``row``, ``component`` (smallest row reachable) for every row in ``edges(a, b)``.

    Each round takes the smallest label among a row's neighbours and then the label of that label, so a
    component is settled after about the logarithm of its longest path. Rows with many neighbours are
    pre-aggregated before the shuffle.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))),
                       "edges")
    labels = materialize(both.groupBy(F.col("a").alias("row")).agg(F.min(F.least("a", "b")).alias("component")),
                         "labels")
    while True:
        seen = (both.join(labels.select(F.col("row").alias("b"), "component"), "b")
                .groupBy(F.col("a").alias("row")).agg(F.min("component").alias("seen")))
        lower = labels.join(seen, "row").select(
            "row", F.col("component").alias("was"), F.least("component", "seen").alias("component"))
        parent = labels.select(F.col("row").alias("component"), F.col("component").alias("above"))
        jumped = materialize(lower.join(parent, "component").select(
            "row", "was", F.least("component", "above").alias("component")), "labels")
        done = jumped.filter("was <> component").isEmpty()
        labels = jumped.select("row", "component")
        if done:
            return labels
