"""Many-to-one join that stays balanced when one key holds a large share of the rows.

``big`` has many rows per key, ``small`` one row per key plus its row count on
the big side (known from an earlier aggregation). Keys whose count reaches
``hot_rows`` are *hot*: each is split into ``ceil(count / rows_per_salt)`` salt
values - so a key holding a third of ten billion rows becomes a few thousand
tasks, not one - and its single small-side row is copied once per salt. Cold keys
keep salt 0 and are not copied.

The hot-key list (key, salt count) is broadcast to tag big-side rows without
shuffling them. Its size has a proven bound: a key counts as hot only with a share
of ``1 / MAX_HOT_KEYS`` of all rows, and there are at most ``MAX_HOT_KEYS`` of those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


MAX_HOT_KEYS = 100_000


def salted_join(big: DataFrame, small: DataFrame, key: str, *, count_col: str,
                order_col: str, hot_rows: int = 1_000_000, rows_per_salt: int | None = None,
                how: str = "inner", counts: DataFrame | None = None) -> DataFrame:
    """Join ``big`` to ``small`` on ``key``; ``order_col`` (a unique big-side id) picks salts.

    ``counts``: a table of ``key`` and ``count_col``, where ``small`` is more work to evaluate; a row may repeat.
    """
    counts = small if counts is None else counts
    total = counts.agg(F.sum(count_col).alias("n")).first()["n"] or 0
    hot_rows = max(hot_rows, -(-total // MAX_HOT_KEYS))
    n_salts = F.ceil(F.col(count_col) / F.lit(rows_per_salt or hot_rows)).cast("int")
    hot = counts.filter(F.col(count_col) >= hot_rows).select(key, n_salts.alias("_n_salts"))
    if hot.isEmpty():
        return big.join(small.drop(count_col), key, how)

    tagged = big.join(F.broadcast(hot.distinct()), key, "left")
    big_s = tagged.withColumn(
        SALT, F.when(F.col("_n_salts").isNotNull(),
                     F.pmod(F.xxhash64(F.col(order_col)), F.col("_n_salts")))
        .otherwise(F.lit(0)).cast("int")).drop("_n_salts")
    small_s = small.withColumn(
        SALT, F.explode(F.when(F.col(count_col) >= hot_rows, F.sequence(F.lit(0), n_salts - 1))
                        .otherwise(F.array(F.lit(0))))).drop(count_col)
    return big_s.join(small_s, [key, SALT], how).drop(SALT)
