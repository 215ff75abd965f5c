"""Exact distinct counts by bitmaps over dense key numbers.

``count(DISTINCT ID)`` shuffles every distinct (group, id).  With the ids
numbered once from 1 without gaps, a group's ids are bits: each task ORs
them into one bitmap of 32,768 bits per group and bucket, and only these
bitmaps (4 KB each) are shuffled and ORed again.  Bitmaps of several
deliveries, years or countries merge in the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.operators.joins import lookup_join

# hash parts that are numbered independently of each other
_PARTS = 256


def number_keys(keys: DataFrame, key: str, number: str = "NUMBER") -> DataFrame:
    """``key`` and ``number``: every distinct key (null left out) with a number, from 1 without gaps, the same in every run.

    Two levels: a rank inside each of a fixed number of hash parts, and the
    keys in the parts before.  Write the result once and keep it with the
    data; new keys can be appended behind the largest number.
    """
    k = keys.filter(F.col(key).isNotNull()).select(key).distinct().withColumn("_part", F.pmod(F.xxhash64(key), F.lit(_PARTS)))
    sizes = k.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # at most _PARTS rows
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(key))
    return k.withColumn("_at", inside).join(before, "_part").select(key, (F.col("_before") + F.col("_at")).alias(number))


def with_numbers(rows: DataFrame, numbers: DataFrame, key: str) -> DataFrame:
    """``rows`` with their key's number (null for unknown keys)."""
    return lookup_join(rows, numbers, key, "left")


def key_bitmaps(rows: DataFrame, number: str | Column = "NUMBER", by: Sequence[str] = ()) -> DataFrame:
    """``by``, bucket, bits: the numbers that occur, as one bitmap per group and bucket of 32,768 numbers."""
    n = F.col(number) if isinstance(number, str) else number
    some = rows.filter(n.isNotNull())
    return some.groupBy(*by, F.bitmap_bucket_number(n).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("bits"))


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Bitmaps of the union: per group of ``by`` (fewer columns than before, or the same) and bucket."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(bitmaps: DataFrame, by: Sequence[str] = (), alias: str = "distinct_count") -> DataFrame:
    """How many numbers the bitmaps of each group hold (one row, also for no bitmaps, without ``by``)."""
    total = F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("long").alias(alias)
    return bitmaps.groupBy(*by).agg(total) if by else bitmaps.agg(total)
