"""Explicit split of hot keys for a shuffle equi join (heavy-hitter salting).

Used for the payment -> account join when the account side is too large to
broadcast and AQE's skew-join splitting is not available (AQE or its skew
handling switched off) or not wanted.

1. Count rows per key on the large side.  The count is partially aggregated
   in every task before its shuffle, so it moves one row per key per task.
2. Keys with more than ``rows_per_task`` rows are hot.  Their number is at
   most total_rows / rows_per_task.  Up to ``max_hot_keys`` of them come to
   the driver once and are broadcast from there (so the counting pass is not
   recomputed); a longer list is joined by shuffle, and splits all the same.
3. A hot key with ``n`` rows is split into ``ceil(n / rows_per_task)`` salts:
   large-side rows get ``salt = pmod(xxhash64(row columns), salts)``, the
   matching small-side rows are replicated once per salt.  Cold keys keep
   salt 0 and one copy.  The join runs on ``(key, salt)``.

Every row is kept; only the placement of hot keys changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_ROWS_PER_TASK = 5_000_000
MAX_HOT_KEYS = 100_000


def hot_keys(large: DataFrame, key: str, rows_per_task: int) -> DataFrame:
    """(key, salts) for keys above the per-task budget."""
    return (large.groupBy(F.col(key).alias("_hk")).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > rows_per_task)
            .select("_hk", F.ceil(F.col("_n") / F.lit(rows_per_task)).cast("int").alias("_salts")))


def salted_join(large: DataFrame, small: DataFrame, large_key: str, small_key: str,
                how: str = "inner", rows_per_task: int = DEFAULT_ROWS_PER_TASK,
                max_hot_keys: int = MAX_HOT_KEYS) -> DataFrame:
    """``large JOIN small ON large_key = small_key`` with hot keys split over tasks."""
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    counted = hot_keys(large, large_key, rows_per_task)
    rows = counted.limit(max_hot_keys + 1).collect()
    if not rows:
        return large.join(small, large[large_key] == small[small_key], how)
    if len(rows) <= max_hot_keys:
        hot = F.broadcast(large.sparkSession.createDataFrame(rows, counted.schema))
    else:
        hot = counted.hint("merge")
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in large.columns])
    big = (large.join(hot, large[large_key] == hot["_hk"], "left")
                .withColumn("_salt", F.when(F.col("_salts").isNull(), F.lit(0))
                            .otherwise(F.pmod(row_hash, F.col("_salts"))))
                .drop("_hk", "_salts"))
    little = (small.join(hot, small[small_key] == hot["_hk"], "left")
                   .withColumn("_salt", F.explode(F.sequence(
                       F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
                   .drop("_hk", "_salts")
                   .withColumnRenamed("_salt", "_salt_s"))
    cond = (big[large_key] == little[small_key]) & (big["_salt"] == little["_salt_s"])
    return big.join(little, cond, how).drop("_salt", "_salt_s")
