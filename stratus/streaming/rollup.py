"""Country-year answers kept up to date by deliveries instead of being recomputed.

Each delivery (a micro-batch of the ingest, or a batch of files) is
reduced to mergeable states per country, year and element: rows, values,
their sum, minimum and maximum.  The states of a delivery are a folder of
its own, so a delivery that comes again replaces itself.  Answers merge
the states of all deliveries; no observation is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.operators.joins import lookup_join
from stratus.sources.lake import prepare_observations

KEYS = ("COUNTRY_CODE", "YEAR", "ELEMENT")
STATE = "COUNTRY_CODE string, YEAR int, ELEMENT string, n_rows long, n_values long, total double, least double, most double"


def country_year_states(daily: DataFrame) -> DataFrame:
    """Mergeable states of some observations: one row per country, year and element (partial sums first, map-side)."""
    value = F.col("VALUE").cast("double")
    return prepare_observations(daily).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(value).alias("n_values"),
        F.sum(value).alias("total"),
        F.min(value).alias("least"),
        F.max(value).alias("most"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One state per key from any number of states; merging is associative."""
    return states.groupBy(*KEYS).agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.sum("total").alias("total"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    )


def _settled(spark: SparkSession, path: str) -> list[str]:
    """Deliveries that a compaction has merged (names only)."""
    folder = f"{path.rstrip('/')}/settled"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return []
    return [r.name for r in spark.read.schema("name string").parquet(folder).collect()]


def add_delivery(daily: DataFrame, path: str, delivery: str) -> bool:
    """Put a delivery's states under ``path``; the same delivery again replaces its states.

    A delivery that a compaction has merged already is refused (False): its
    states cannot be taken out of the merged ones.
    """
    if delivery in _settled(daily.sparkSession, path):
        return False
    country_year_states(daily).write.mode("overwrite").parquet(f"{path.rstrip('/')}/states/DELIVERY={delivery}")
    return True


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """The merged states of all deliveries."""
    return merge_states(spark.read.schema(STATE).parquet(f"{path.rstrip('/')}/states"))


def compact_states(spark: SparkSession, path: str, into: str) -> str:
    """Merge all deliveries under ``path`` into a rollup of one state file set under ``into``, which remembers their names.

    ``path`` stays as it is; readers and the ingest move to ``into`` when
    it is complete.
    """
    root = into.rstrip("/")
    states = spark.read.schema(STATE + ", DELIVERY string").parquet(f"{path.rstrip('/')}/states")
    names = states.select(F.col("DELIVERY").alias("name")).distinct()
    before = spark.createDataFrame([(n,) for n in _settled(spark, path)], "name string")
    merge_states(states).write.parquet(f"{root}/states/DELIVERY=merged")
    names.unionByName(before).filter("name <> 'merged'").distinct().write.parquet(f"{root}/settled")
    return root


def average_by_country_year(states: DataFrame, countries: DataFrame | None = None, element: str = "PRCP") -> DataFrame:
    """The same rows as ``country_year_average`` over all observations, from the states."""
    s = states.filter(F.col("ELEMENT") == element)
    agg = s.select("COUNTRY_CODE", "YEAR", (F.col("total") / F.col("n_values")).alias("AVERAGE"))
    if countries is None:
        return agg
    names = countries.select(F.col("CODE").alias("COUNTRY_CODE"), "COUNTRY_NAME")
    return lookup_join(agg, names, "COUNTRY_CODE", "left")


def rows_per_year(states: DataFrame) -> DataFrame:
    """Observations per year, from the states."""
    return states.groupBy("YEAR").agg(F.sum("n_rows").alias("observation_count"))
