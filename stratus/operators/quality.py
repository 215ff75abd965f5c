"""Referential checks: orphan keys, match counts, key uniqueness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` whose key has no match in ``right`` (LEFT ANTI).

    The right keys are de-duplicated first: a partial (map-side)
    aggregate, so when ``right`` is the fact table a key holding a third
    of all rows reaches the join as one row per map task.  (AQE can split
    a skewed *left* side of an anti join, never its build side.)
    """
    r = right.select(F.col(right_key).alias("_rk")).distinct()
    return left.join(r, left[left_key] == r["_rk"], "left_anti")


def orphan_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Distinct keys of ``left`` missing from ``right`` (set difference of ids)."""
    lk = left.select(F.col(left_key).alias("ID")).distinct()
    rk = right.select(F.col(right_key).alias("ID")).distinct()
    return lk.join(rk, "ID", "left_anti")


def match_count(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Left join as a check: total fact rows and rows that found the key.

    Fact rows are counted per key before the join (map-side partial
    counts), so only one row per key meets the dimension, whose keys are
    de-duplicated as well.
    """
    d = dim.select(F.col(dim_key).alias("_dk")).distinct().withColumn("_hit", F.lit(1))
    per_key = fact.groupBy(F.col(fact_key).alias("_fk")).agg(F.count(F.lit(1)).alias("_n"))
    j = per_key.join(d, F.col("_fk") == F.col("_dk"), "left")
    return j.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("_hit").isNotNull(), F.col("_n"))), F.lit(0)).alias("matched_rows"),
    )


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once (empty when the key is unique)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
