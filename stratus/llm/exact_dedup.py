"""Exact duplicate texts, with frequent texts split off before the shuffle.

Native DataFrame / SQL functions only.  Every text is reduced to the
SHA-256 of its normalised form once, in a written table of (id, digest).

* A Misra-Gries sketch (``approx_top_k``, built per partition and merged in
  two levels) names the candidates for frequent digests: every digest with
  more than rows / ``tracked`` copies is among them, and there are at most
  ``heavy`` of them.
* Their exact counts and winners come from one aggregate over the rows
  that hold them; the table of at most ``heavy`` verified rows is
  broadcast, and rows of frequent texts are answered map-side: a text that
  makes up a third of the corpus is never shuffled row by row.
* The remaining digests are counted by a shuffle on the digest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import ascii_lower, written


def text_digest(text: F.Column) -> F.Column:
    """Hex SHA-256 of the text with A-Z lower-cased; null counts as empty."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def frequent_digests(digests: DataFrame, heavy: int = 1000, tracked: int = 4096, fan_in: int = 64) -> DataFrame:
    """At most ``heavy`` digests, all that exceed rows / ``tracked`` among the first of them.

    ``fan_in`` first-level sketches are merged before the last one, so no
    task reads a sketch from every map task.
    """
    partial = digests.groupBy((F.spark_partition_id() % fan_in).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(text_sha256, {tracked})").alias("sketch")
    )
    # grouped, so that empty partitions hold no sketch at all
    merged = partial.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    return merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {heavy})")).alias("top")).select(
        F.col("top.item").alias("text_sha256")
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = 1000) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    ``keep_id`` is the largest id among rows of equal text (nulls equal
    empty texts).  ``kept`` is true on the rows that carry it: an id that
    is repeated with the same text is kept on each of them, a group whose
    ids are all null has no ``keep_id`` and keeps all of its rows.  An
    empty table gives an empty result.  Other columns are ignored.
    """
    digests = written(
        docs.select(F.col(id_col).alias("doc_id"), text_digest(F.col(text_col)).alias("text_sha256")), "dedup-digests"
    )
    totals = [F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    # at most `heavy` rows on either broadcast side
    winners = digests.join(F.broadcast(frequent_digests(digests, heavy)), "text_sha256").groupBy("text_sha256").agg(*totals)
    winners = written(winners.filter("group_size > 1"), "dedup-winners")
    split = digests.join(F.broadcast(winners), "text_sha256", "left")
    frequent = split.filter(F.col("group_size").isNotNull())
    rest = split.filter(F.col("group_size").isNull()).select("doc_id", "text_sha256")
    # a join of two scans: Spark can split a digest that many rows share, though not as many as the frequent ones
    sizes = written(rest.groupBy("text_sha256").agg(*totals), "dedup-sizes")
    rest = rest.join(sizes, "text_sha256")
    cols = ["doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"]
    return frequent.select(*cols).unionByName(rest.select(*cols))
