"""Deterministic hash-ordered sampling (L5, L6, the selection step of L3).

Rows are ordered by a portable 32-bit hash key (see ``functions.hashing``) and
the first k rows of each group are kept. Two forms:

* ``top_n_per_group`` - constant n: ``row_number() <= n``. Spark plans this
  with a partial WindowGroupLimit before the shuffle, so each map task ships
  at most n rows per group and a huge group never reaches one task whole.
* ``lowest_k_per_group`` - k given per group (e.g. a third of the group). The
  hash range is cut into 2^bits buckets; a small count table per
  (group, bucket) gives each bucket's offset, and rows are ranked only within
  their (group, bucket). Exact, and a group holding a third of all rows is
  spread over 2^bits tasks-worth of buckets instead of one sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def top_n_per_group(df: DataFrame, group_cols: list[str], order_cols: list, n: int) -> DataFrame:
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def lowest_k_per_group(df: DataFrame, group_cols: list[str], hash_col: str, tie_col: str,
                       k_of_size, bits: int = 20) -> DataFrame:
    """Keep the k rows with the smallest (hash, tie) per group.

    ``k_of_size`` maps the group-size Column to k (e.g. ``lambda n: floor(n / 3)``).
    ``hash_col`` must be a non-negative key below 2^32.
    """
    bucket = F.shiftright(F.col(hash_col), 32 - bits)
    rows = df.withColumn("_bucket", bucket)
    counts = rows.groupBy(*group_cols, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    g = Window.partitionBy(*group_cols)
    before = Window.partitionBy(*group_cols).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts
               .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
               .withColumn("_k", k_of_size(F.sum("_n").over(g)))
               .where(F.col("_before") < F.col("_k"))
               .select(*group_cols, "_bucket", "_before", "_k", "_n"))
    joined = rows.join(offsets, [*group_cols, "_bucket"])
    rank = F.row_number().over(Window.partitionBy(*group_cols, "_bucket").orderBy(hash_col, tie_col))
    ranked = joined.withColumn("_rank", rank)
    kept = ranked.where(F.col("_before") + F.col("_rank") <= F.col("_k"))
    return kept.drop("_bucket", "_before", "_k", "_n", "_rank")
