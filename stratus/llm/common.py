"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.session import output_path

# What counts as white space between words
WHITE = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_BATCH, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` as a Parquet table in the cluster's shared folder, read back.

    Cuts lineage: a lost executor re-reads the table instead of redoing
    what led to it.
    """
    spark = df.sparkSession
    path = output_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, size: int = 4 * 1024 * 1024) -> None:
    """Has Spark hand texts to Python in batches of ``size`` bytes, where the session keeps its default of 64 MB.

    A task holds a batch in the JVM and in Python, each in buffers that may
    be twice as long, and every core runs a task.
    """
    if spark.conf.get(_BATCH, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH, str(size))


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only.  Pure ASCII text takes the byte-wise ``lower``."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def word_count(c: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text (long; null text: 0)."""
    edges = F.when(c.rlike(f"^{WHITE}"), 1).otherwise(0) + F.when(c.rlike(f"{WHITE}\\z"), 1).otherwise(0)
    n = F.size(F.split(c, f"{WHITE}+")) - edges
    return F.when(F.coalesce(F.length(c), F.lit(0)) == 0, 0).otherwise(n).cast("long")


def id_digest(id_col: str) -> Column:
    """A key's position in the shuffled order: md5 of its text, null as a text of its own."""
    return F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).cast("binary"))


def hex_digits(rows: int, per_bucket: int) -> int:
    """How many leading hex digits cut ``rows`` keys into buckets of about ``per_bucket``."""
    d = 0
    while rows > per_bucket * 16**d:
        d += 1
    return d


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores until no input column clashes with it (case-insensitive)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name
