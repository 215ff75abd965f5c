"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node of ``edges`` (a, b; any order, repeats allowed).

    Each round hangs every node's larger neighbours, then its smaller ones,
    on the smallest node near it, until the edges are stars: the number of
    rounds grows with the logarithm of the longest chain, and one is enough
    for stars.  All steps are aggregates with partial minima and joins, on
    edges in written tables.
    """
    e = written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    while not _are_stars(e):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
        hung = both.join(low, "u").filter("v > u").select(F.col("v").alias("a"), F.col("low").alias("b")).distinct()
        hung = written(hung, "edges-large")
        joined = hung.join(hung.groupBy("a").agg(F.min("b").alias("low")), "a")
        e = joined.select(F.col("a"), F.col("low").alias("b")).union(joined.select("b", "low")).filter("a <> b").distinct()
        e = written(e, "edges-small")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _are_stars(e: DataFrame) -> bool:
    """Whether each node hangs on one smaller node at most, and none hangs on a hanging one."""
    roles = e.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    roles = roles.union(e.select("b", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("hangs").alias("n"), F.max("holds").alias("holds"))
    return roles.filter("n > 1 or (n = 1 and holds = 1)").isEmpty()
