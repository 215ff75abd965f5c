"""Join helper: dimension lookups with a checked key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_rows(dim: DataFrame, key: str) -> DataFrame:
    """``dim`` with the promise that ``key`` is unique: a repeated key raises when the rows are read.

    A repeated code in a lookup file would otherwise multiply the rows that
    refer to it without any sign.
    """
    others = [c for c in dim.columns if c != key]
    one = dim.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(c) for c in others])
    told = F.concat(F.lit(f"{key} is not unique: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    checked = F.when(F.col("_n") > 1, F.raise_error(told).cast(dim.schema[key].dataType)).otherwise(F.col(key))
    return one.select(checked.alias(key), *others).select(*dim.columns)


def lookup_join(fact: DataFrame, dim: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Join ``fact`` to a dimension table whose key must be unique.

    No broadcast hint: Spark checks the dimension's size at plan time
    (``spark.sql.autoBroadcastJoinThreshold``) and again from the real
    shuffle output (``spark.sql.adaptive.autoBroadcastJoinThreshold``),
    broadcasts under the threshold and shuffles beyond it.
    """
    return fact.join(unique_rows(dim, on), on=on, how=how)
