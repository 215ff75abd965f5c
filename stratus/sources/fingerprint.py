"""Reconciliation by content: an order-independent fingerprint of a table.

A row has two 64-bit hashes of all its values; a table's fingerprint is
its row count and the sums of both.  Sums need no order and merge over
tasks, so the write observes them on the way and the read-back recomputes
them in one pass.  A changed, lost or doubled row changes the sums.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.sources.sinks import write_csv


@dataclass(frozen=True)
class Fingerprint:
    rows: int
    first: Decimal
    second: Decimal


def _sums(df: DataFrame) -> list[Column]:
    """Row count and the sums of two row hashes.  Hash functions skip nulls, so their places are hashed as well."""
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    blanks = [c.isNull() for c in columns]
    wide = T.DecimalType(28, 0)
    hashes = [F.xxhash64(F.lit(seed), *blanks, *columns).cast(wide) for seed in (1, 2)]
    return [F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(h), F.lit(Decimal(0))).alias(n) for h, n in zip(hashes, ("first", "second"))]]


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: rows, first, second.  Equal for equal bags of rows of the same column names and types."""
    return df.agg(*_sums(df))


def write_fingerprinted(df: DataFrame, path: str, compression: str | None = None, null_text: str = "\\N") -> Fingerprint:
    """Write CSV (nulls apart from blanks) and return the fingerprint that the write has seen; nothing is computed twice."""
    seen = Observation()
    write_csv(df.observe(seen, *_sums(df)), path, compression, null_text=null_text)
    got = seen.get
    return Fingerprint(got["rows"], got["first"], got["second"])


def reconcile_content(spark: SparkSession, path: str, schema: T.StructType, want: Fingerprint, null_text: str = "\\N") -> DataFrame:
    """Read the CSV back by ``schema`` (that of the written rows) and compare: data_rows, source_rows, same_rows, same_content."""
    back = spark.read.option("header", "true").option("multiLine", "true").option("nullValue", null_text).schema(schema).csv(path)
    got = fingerprint(back)
    same = (F.col("first") == F.lit(want.first)) & (F.col("second") == F.lit(want.second))
    return got.select(
        F.col("rows").alias("data_rows"),
        F.lit(want.rows).cast("long").alias("source_rows"),
        (F.col("rows") == F.lit(want.rows)).alias("same_rows"),
        ((F.col("rows") == F.lit(want.rows)) & same).alias("same_content"),
    )
