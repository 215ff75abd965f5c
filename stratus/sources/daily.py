"""Daily observation files: header-less, comma separated, usually gzip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.functions.columns import obs_minute
from stratus.layouts import DAILY_DATE_FORMAT, DAILY_SCHEMA


def read_daily_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = DAILY_SCHEMA,
    base_path: str | None = None,
) -> DataFrame:
    """Read daily CSV with an explicit schema (never inferred).

    ``path`` may be a file, a directory or a Hadoop glob such as
    ``.../YEAR={199[8-9],2000}``.  gzip is picked from the file extension;
    a gzip file is not splittable, so each file is one task - convert to
    the Parquet lake once (``write_observation_lake``) for repeated work.
    Malformed dates / numbers become null and the row is kept
    (``daily_rejects`` counts such lines).
    """
    reader = (
        spark.read.option("header", "false")
        .option("delimiter", ",")
        .option("dateFormat", DAILY_DATE_FORMAT)
        .option("mode", "PERMISSIVE")
        .schema(schema)
    )
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.csv(path)


def with_obs_minute(daily: DataFrame, time_col: str = "OBV_TIME") -> DataFrame:
    """Add ``OBS_MINUTE`` (0..1440) derived from the ``HHmm`` text column."""
    return daily.withColumn("OBS_MINUTE", obs_minute(time_col))


def read_untyped_csv(spark: SparkSession, path: str) -> DataFrame:
    """Schema-less read: columns ``_c0.._cN``, all strings (count / peek only)."""
    return spark.read.option("header", "false").option("inferSchema", "false").csv(path)


def format_daily_csv_columns(df: DataFrame) -> DataFrame:
    """Shape a typed daily frame as the text columns of the archive format."""
    return df.select(
        "ID",
        F.date_format("DATE", DAILY_DATE_FORMAT).alias("DATE"),
        "ELEMENT",
        F.col("VALUE").cast("string").alias("VALUE"),
        *[
            (F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c)
            for c in ("MFLAG", "QFLAG", "SFLAG", "OBV_TIME")
        ],
    )


def write_daily_archive(obs: DataFrame, path: str, by_year: bool = True) -> str:
    """Write observations in the archive format: gzip CSV, no header,
    ``yyyyMMdd`` dates; one directory per YEAR when ``by_year`` (rows are
    dealt by year first, so a year's files grow with its size, not with
    the number of tasks)."""
    text = format_daily_csv_columns(obs)
    w = text
    if by_year:
        w = text.withColumn("YEAR", F.substring("DATE", 1, 4).cast("int")).hint("rebalance", "YEAR")
    writer = w.write.mode("overwrite").option("header", "false").option("compression", "gzip")
    if by_year:
        writer = writer.partitionBy("YEAR")
    writer.csv(path)
    return path


def daily_rejects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Count the malformed lines of daily CSV files in one scan of the raw
    text: a wrong number of fields, a date that is not ``yyyyMMdd`` or a
    value that is not a number (blank fields are missing, not malformed).
    One row: lines, rejected_lines.

    The typed reader keeps such rows with nulls; this makes them visible.
    It works on the text itself, so no parse is skipped by column pruning.
    """
    n_fields = len(DAILY_SCHEMA.fields)
    parts = F.split(F.col("value"), ",", -1)
    # F.get: null past the end (short lines are caught by the field count)
    date_txt, value_txt = F.trim(F.get(parts, 1)), F.trim(F.get(parts, 3))
    bad = (
        (F.size(parts) != n_fields)
        | ((date_txt != "") & (~date_txt.rlike("^[0-9]{8}$") | F.try_to_timestamp(date_txt, F.lit(DAILY_DATE_FORMAT)).isNull()))
        | ((value_txt != "") & value_txt.try_cast("float").isNull())
    )
    lines = spark.read.text(path)
    return lines.agg(F.count(F.lit(1)).alias("lines"), F.count_if(bad).alias("rejected_lines"))


# --- quarantine: what a line of the archive may fail by
_CHECKED = T.StructType([*DAILY_SCHEMA.fields, T.StructField("RAW_LINE", T.StringType())])


def read_daily_checked(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The daily files with every line's defects, in one scan.

    The typed columns, and for lines with defects RAW_LINE, SOURCE_FILE and
    FAILED_FIELDS: ``fields`` (their number is wrong), DATE, VALUE (not
    what the layout says) or OBV_TIME (no time of day).  Blank fields are
    missing, not malformed; for good lines the three columns are null.
    The lines go through Spark's own CSV parser, so quotes, dates and
    numbers are read as by ``read_daily_csv``.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    options = {
        "mode": "PERMISSIVE", "delimiter": ",", "dateFormat": DAILY_DATE_FORMAT, "columnNameOfCorruptRecord": "RAW_LINE",
    }
    texts = ", ".join(f"{f.name} string" for f in DAILY_SCHEMA.fields) + ", MORE string"
    r = lines.select(
        "value",
        "file",
        F.from_csv("value", F.lit(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _CHECKED.fields)), options).alias("typed"),
        F.from_csv("value", F.lit(texts), {"delimiter": ","}).alias("texts"),
    )
    given = lambda c: F.trim(F.coalesce(F.col(f"texts.{c}"), F.lit(""))) != ""
    parts = F.size(F.split("value", ",", -1))
    short = F.col("typed.RAW_LINE").isNotNull() & (parts != len(DAILY_SCHEMA.fields))
    failed = F.array_compact(
        F.array(
            F.when(short, F.lit("fields")),
            *[F.when(given(c) & F.col(f"typed.{c}").isNull(), F.lit(c)) for c in ("DATE", "VALUE")],
            F.when(given("OBV_TIME") & obs_minute("typed.OBV_TIME").isNull(), F.lit("OBV_TIME")),
        )
    )
    r = r.withColumn("failed", failed).withColumn("bad", F.size("failed") > 0)
    return r.select(
        *[F.col(f"typed.{f.name}").alias(f.name) for f in DAILY_SCHEMA.fields],
        F.when(F.col("bad"), F.col("value")).alias("RAW_LINE"),
        F.when(F.col("bad"), F.col("file")).alias("SOURCE_FILE"),
        F.when(F.col("bad"), F.col("failed")).alias("FAILED_FIELDS"),
    )


def split_daily(spark: SparkSession, path: str | list[str], out: str) -> tuple[DataFrame, DataFrame]:
    """Write the daily files to ``out`` once, good lines and quarantined ones apart; both as DataFrames.

    One scan of the text and one job: the folder ``REJECTED=false`` holds
    the typed rows (the lake is written from there), ``REJECTED=true`` the
    lines that failed, whole, with their file and fields.
    """
    checked = read_daily_checked(spark, path)
    checked.withColumn("REJECTED", F.col("FAILED_FIELDS").isNotNull()).write.mode("overwrite").partitionBy("REJECTED").parquet(out)
    both = spark.read.schema(checked.schema.add("REJECTED", "boolean")).parquet(out)
    good = both.filter(~F.col("REJECTED")).select(*DAILY_SCHEMA.fieldNames())
    return good, both.filter("REJECTED").select("RAW_LINE", "SOURCE_FILE", "FAILED_FIELDS")
