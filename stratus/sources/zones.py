"""A zone map of the lake: which values each file can hold.

Spark opens every file of the partitions it reads, if only for the footer.
The zone map keeps per file the smallest and largest country, element and
day, so a question reads only files that can hold an answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ZONE_COLUMNS = ("COUNTRY_CODE", "ELEMENT", "DATE")


def build_zones(spark: SparkSession, lake: str, columns: Sequence[str] = ZONE_COLUMNS) -> DataFrame:
    """One row per file with rows: file_path, n_rows, and least_c, most_c, nulls_c of every column c.

    One scan of these columns; write the result next to the lake.  Files
    of later batches are added by a zone map of theirs (``unionByName``).
    """
    rows = spark.read.parquet(lake).select(F.col("_metadata.file_path").alias("file_path"), *columns)
    each = [
        x
        for c in columns
        for x in (F.min(c).alias(f"least_{c}"), F.max(c).alias(f"most_{c}"), F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"))
    ]
    return rows.groupBy("file_path").agg(F.count(F.lit(1)).alias("n_rows"), *each)


def may_hold(column: str, values: Sequence | None = None, least=None, most=None) -> Column:
    """Whether a file's zone can hold one of ``values``, or a value from ``least`` to ``most`` (either may be open)."""
    lo, hi = F.col(f"least_{column}"), F.col(f"most_{column}")
    found = F.lit(False)
    if values is not None:
        for v in values:
            found = found | ((lo <= F.lit(v)) & (hi >= F.lit(v)))
    else:
        found = F.lit(True)
        if least is not None:
            found = found & (hi >= F.lit(least))
        if most is not None:
            found = found & (lo <= F.lit(most))
    return F.coalesce(found, F.lit(False))  # a file of nulls only has no zone


def read_zones(spark: SparkSession, lake: str, zones: DataFrame, can_hold: Column) -> DataFrame:
    """The lake's files whose zone passes ``can_hold``.

    The zone map rules files out, not rows: filter the result by the
    question's own predicate as well.  The names of the chosen files come
    to the driver, as those of all files do when Spark lists a folder.
    """
    files = sorted(r.file_path for r in zones.filter(can_hold).select("file_path").collect())
    everything = spark.read.parquet(lake)
    if not files:
        return everything.filter("false")
    return spark.read.schema(everything.schema).option("basePath", lake).parquet(*files)
