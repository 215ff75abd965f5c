"""Data-lake file inventory as a Spark job (replaces shell listing tools)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_inventory(spark: SparkSession, path: str, count_rows: str | None = None) -> DataFrame:
    """One row per data file: file_path, file_bytes, modified.

    Lists the files by the ``binaryFile`` source without reading their
    content, so files of blank lines are listed as well; that source leaves
    out files of zero bytes and hidden ones.  With ``count_rows`` (a
    format, such as ``csv``) one scan adds row_count, the records of each
    file (0 for files without any).
    """
    files = spark.read.format("binaryFile").load(path)
    files = files.select(F.col("path").alias("file_path"), F.col("length").alias("file_bytes"), F.col("modificationTime").alias("modified"))
    if count_rows is None:
        return files
    rows = spark.read.format(count_rows).load(path).select(F.col("_metadata.file_path").alias("file_path"))
    rows = rows.groupBy("file_path").agg(F.count(F.lit(1)).alias("row_count"))
    return files.join(rows, "file_path", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0)))


def inventory_totals(files: DataFrame) -> DataFrame:
    """One row: files and bytes of an inventory (and rows, where it counts them)."""
    totals = [F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("file_bytes"), F.lit(0)).alias("bytes")]
    if "row_count" in files.columns:
        totals.append(F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"))
    return files.agg(*totals)
