"""Columnar copy of the daily observations, partitioned by YEAR.

The archive arrives as one gzip CSV per year; gzip cannot be split, so a
year is one task on every read.  Converting once to Parquet gives
splittable files, column pruning, row-group skipping on COUNTRY_CODE /
ELEMENT (rows are clustered by them inside each year) and directory
pruning on YEAR.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions.columns import country_code, obs_minute, year_int


def prepare_observations(daily: DataFrame) -> DataFrame:
    """Add the derived keys the analytics filter on: YEAR (int), COUNTRY_CODE and OBS_MINUTE.

    Batch conversion and streaming ingest both go through here, so their
    lakes have one schema.
    """
    out = daily
    if "YEAR" not in out.columns:
        out = out.withColumn("YEAR", year_int("DATE"))
    if "COUNTRY_CODE" not in out.columns:
        out = out.withColumn("COUNTRY_CODE", country_code("ID"))
    if "OBS_MINUTE" not in out.columns and "OBV_TIME" in out.columns:
        out = out.withColumn("OBS_MINUTE", obs_minute("OBV_TIME"))
    return out


def write_observation_lake(
    daily: DataFrame,
    path: str,
    max_records_per_file: int = 5_000_000,
    row_group_bytes: int = 16 * 1024 * 1024,
    batch: str | None = None,
) -> str:
    """Write the observations as Parquet partitioned by YEAR (and BATCH inside it).

    ``rebalance`` on (YEAR, COUNTRY_CODE) groups each year's country into
    the same files, and AQE sizes the write tasks from the real shuffle
    output (``spark.sql.adaptive.advisoryPartitionSizeInBytes``): a country
    holding a third of all rows is split into many tasks, small ones are
    merged - the number of tasks grows with the data instead of being a
    fixed partition count.  Sorting inside a task by ELEMENT / ID / DATE
    lets Parquet min/max statistics skip row groups for element, country
    and station filters; ``row_group_bytes`` keeps several row groups per
    file so there is something to skip (one 128 MB group per file would
    span every element).

    Without ``batch`` the whole lake is replaced.  With it only that
    batch's partitions are, so writing a batch again changes nothing.
    """
    obs = prepare_observations(daily).withColumn("BATCH", F.lit(batch or "all"))
    (
        obs.hint("rebalance", "YEAR", "COUNTRY_CODE")
        .sortWithinPartitions("YEAR", "COUNTRY_CODE", "ELEMENT", "ID", "DATE")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if batch is None else "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .option("parquet.block.size", row_group_bytes)
        .partitionBy("YEAR", "BATCH")
        .parquet(path)
    )
    return path


def read_observation_lake(spark: SparkSession, path: str) -> DataFrame:
    """Read the lake; YEAR comes back as an int partition column."""
    return spark.read.parquet(path).drop("BATCH").withColumn("YEAR", F.col("YEAR").cast("int"))
