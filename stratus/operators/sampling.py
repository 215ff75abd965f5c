"""Reproducible samples: the k rows of a group whose keys have the smallest digests.

The sample depends on the keys alone, not on partitions, files or runs;
samples of parts merge to the sample of the whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_digest(key: str) -> Column:
    """md5 of the key's text (null as a text of its own)."""
    return F.md5(F.coalesce(F.col(key).cast("string"), F.lit("null")).cast("binary"))


def bottom_k(df: DataFrame, by: Sequence[str], key: str, k: int, digest: str = "DIGEST") -> DataFrame:
    """``df``'s first ``k`` rows per group of ``by`` in the order of their keys' digests (ties: the key), with the digest.

    Spark limits the groups before the shuffle (WindowGroupLimit), so a
    group that holds most rows sends k rows per task.  Rows of one key are
    taken in no order of their own: give a key that is unique in its group.
    """
    marked = df.withColumn(digest, key_digest(key))
    order = Window.partitionBy(*by).orderBy(digest, key)
    return marked.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k).drop("_rank")


def merge_samples(a: DataFrame, b: DataFrame, by: Sequence[str], key: str, k: int) -> DataFrame:
    """The sample of both parts' rows, from the samples of the parts."""
    return bottom_k(a.unionByName(b).drop("DIGEST"), by, key, k)
