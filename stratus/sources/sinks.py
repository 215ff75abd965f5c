"""Writers for result tables, and a read-back reconciliation of written CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_csv(
    df: DataFrame, path: str, compression: str | None = None, header: bool = True, null_text: str | None = None
) -> str:
    """CSV directory (one part file per task), overwrite.

    By default nulls and blank texts both come back as null; with
    ``null_text`` (such as ``\\N``, to be given to the reader as
    ``nullValue``) they stay apart.
    """
    w = df.write.mode("overwrite").option("header", str(header).lower())
    if compression:
        w = w.option("compression", compression)
    if null_text is not None:
        w = w.option("nullValue", null_text)
    w.csv(path)
    return path


def write_counted(df: DataFrame, path: str, keys: list[str] | None = None, single: bool = False, compression: str | None = None) -> int:
    """Write like ``write_csv`` / ``write_sorted`` / ``write_single_file`` and return the rows written.

    The count is observed by the writing job itself; the source is not
    computed a second time.
    """
    shaped = df.repartition(1) if single else df.orderBy(*keys) if keys else df
    seen = Observation()
    # above the sort: the sort's sampling pass must not be counted
    write_csv(shaped.observe(seen, F.count(F.lit(1)).alias("rows")), path, compression)
    return seen.get["rows"]


def write_sorted(df: DataFrame, path: str, keys: list[str], header: bool = True) -> str:
    """Globally sorted output: range-partitioned on ``keys`` and sorted inside.

    ``orderBy`` samples the keys to cut balanced ranges, so part files are
    ordered one after another without funnelling rows into one task.  Name
    enough keys for a total order.
    """
    return write_csv(df.orderBy(*keys), path, header=header)


def write_single_file(df: DataFrame, path: str, header: bool = True) -> str:
    """Exactly one part file.  For small, already aggregated results only:
    ``repartition(1)`` keeps the upstream stages parallel (``coalesce(1)``
    would collapse them into one task as well)."""
    return write_csv(df.repartition(1), path, header=header)


def reconcile_csv(spark: SparkSession, path: str, source_rows: int) -> DataFrame:
    """Check a written CSV directory (with headers) against its source row count.

    The files are parsed as CSV, so a line break inside a quoted field is
    part of its row.  One row: files, data_rows, source_rows, ok.  ``files``
    are the part files that hold rows.
    """
    rows = spark.read.option("header", "true").option("multiLine", "true").csv(path)
    per_file = rows.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    tot = per_file.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("data_rows"))
    source = F.lit(int(source_rows)).cast("long")
    return tot.select("files", "data_rows", source.alias("source_rows"), (F.col("data_rows") == source).alias("ok"))
