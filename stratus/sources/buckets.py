"""The observations as a table bucketed by station (or station and day).

Station-day questions (which days lack a counterpart, daily averages)
group by ID and DATE.  On the YEAR-partitioned lake each of them shuffles
all observations.  Here the shuffle is paid once, by the write: a bucket
holds all rows of its stations, so such groups never leave their task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.sources.lake import prepare_observations

STATION = ("ID",)
# a station that holds a large part of all rows is spread over the buckets by its days
STATION_DAY = ("ID", "DATE")


def buckets_for(total_bytes: int, bytes_per_bucket: int = 512 * 1024 * 1024) -> int:
    """How many buckets hold ``total_bytes`` of Parquet at about ``bytes_per_bucket`` each."""
    return max(1, math.ceil(total_bytes / bytes_per_bucket))


def write_buckets(daily: DataFrame, name: str, path: str, buckets: int, by: Sequence[str] = STATION) -> DataFrame:
    """Write the observations to ``path`` as table ``name`` in ``buckets`` buckets of ``by``, sorted by station, day and element.

    Rows are dealt by the bucket's own hash first, so each task writes one
    file of one bucket, not a file per bucket and task.  An existing table
    is replaced.  Use ``STATION_DAY`` where one station may hold a large
    part of all rows: groups of a station-day stay together, and the
    station spreads over all buckets.
    """
    obs = prepare_observations(daily).repartition(buckets, *by)
    writer = obs.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, *by).sortBy("ID", "DATE", "ELEMENT").saveAsTable(name)
    return daily.sparkSession.table(name)


def open_buckets(spark: SparkSession, name: str, path: str, buckets: int, by: Sequence[str] = STATION) -> DataFrame:
    """Register a table that ``write_buckets`` has written, in a session whose catalog does not know it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    keys = ", ".join(f"`{c}`" for c in by)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet "
        f"CLUSTERED BY ({keys}) SORTED BY (ID, DATE, ELEMENT) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def station_days(obs: DataFrame, present: str = "TMIN", absent: str = "TMAX") -> DataFrame:
    """(ID, DATE) with ``present`` and without ``absent``: the EXCEPT of the two key sets as one aggregate.

    ``subtract`` compares keys null-safe, through expressions that no
    bucketing matches; groups treat null keys as equal in the same way.
    """
    flags = [F.bool_or(F.col("ELEMENT") == e) for e in (present, absent)]
    days = obs.filter(F.col("ELEMENT").isin(present, absent)).groupBy("ID", "DATE").agg(flags[0].alias("p"), flags[1].alias("a"))
    return days.filter("p and not a").select("ID", "DATE")
