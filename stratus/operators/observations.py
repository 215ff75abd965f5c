"""Daily observation analytics on the long (ID, DATE, ELEMENT, VALUE) table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.functions.columns import country_code, year_int
from stratus.layouts import CORE_ELEMENTS
from stratus.operators.joins import lookup_join


def _with_year(obs: DataFrame) -> DataFrame:
    return obs if "YEAR" in obs.columns else obs.withColumn("YEAR", year_int("DATE"))


def _with_cc(obs: DataFrame) -> DataFrame:
    return obs if "COUNTRY_CODE" in obs.columns else obs.withColumn("COUNTRY_CODE", country_code("ID"))


def observations_per_year(obs: DataFrame) -> DataFrame:
    return _with_year(obs).groupBy("YEAR").agg(F.count(F.lit(1)).alias("observation_count"))


def element_counts(obs: DataFrame, elements: Sequence[str] = CORE_ELEMENTS) -> DataFrame:
    """Observations per element for the chosen elements (filter pushed to the scan)."""
    return (
        obs.filter(F.col("ELEMENT").isin(list(elements)))
        .groupBy("ELEMENT")
        .agg(F.count("ELEMENT").alias("observation_count"))
    )


def station_days_missing(obs: DataFrame, present: str = "TMIN", absent: str = "TMAX") -> DataFrame:
    """(ID, DATE) that have ``present`` and no ``absent`` observation.

    One shuffle on (ID, DATE) with two boolean ORs; only the two elements
    are read.  Groups are one station-day, so no group can grow hot.
    """
    return (
        obs.filter(F.col("ELEMENT").isin(present, absent))
        .groupBy("ID", "DATE")
        .agg(
            F.bool_or(F.col("ELEMENT") == present).alias("_p"),
            F.bool_or(F.col("ELEMENT") == absent).alias("_a"),
        )
        .filter(F.col("_p") & ~F.col("_a"))
        .select("ID", "DATE")
    )


def station_days_except(obs: DataFrame, present: str = "TMIN", absent: str = "TMAX") -> DataFrame:
    """The same set as an EXCEPT DISTINCT (``subtract``) of the two key sets."""
    keys = ["ID", "DATE"]
    a = obs.filter(F.col("ELEMENT") == present).select(*keys)
    b = obs.filter(F.col("ELEMENT") == absent).select(*keys)
    return a.subtract(b)


def distinct_count(df: DataFrame, col: str, alias: str) -> DataFrame:
    return df.agg(F.count_distinct(col).alias(alias))


def country_elements(obs: DataFrame, country: str, elements: Sequence[str] = ("TMIN", "TMAX")) -> DataFrame:
    """All observations of ``elements`` in one country.

    On the Parquet lake COUNTRY_CODE is a real, clustered column, so the
    equality filter is pushed into the scan and skips row groups; without
    it the prefix of the id is, which sources can push as well.
    """
    stored = "COUNTRY_CODE" in obs.columns
    here = F.col("COUNTRY_CODE") == country if stored else F.col("ID").startswith(country)
    return _with_cc(obs.filter(here & F.col("ELEMENT").isin(list(elements))))


def daily_series_average(obs: DataFrame) -> DataFrame:
    """Average VALUE per (ID, DATE, ELEMENT) with the int YEAR."""
    return (
        obs.groupBy("ID", "DATE", "ELEMENT")
        .agg(F.avg(F.col("VALUE").cast("double")).alias("AVERAGE"))
        .withColumn("YEAR", year_int("DATE"))
    )


def country_year_average(
    obs: DataFrame, countries: DataFrame | None = None, element: str = "PRCP"
) -> DataFrame:
    """Mean VALUE of ``element`` per (COUNTRY_CODE, YEAR) with the country name.

    Filter + prune first, partial/final hash aggregation on the two keys
    (a hot country only adds rows to its map-side partial aggregate), and
    the name lookup happens AFTER aggregation on the tiny result.
    """
    o = _with_year(_with_cc(obs.filter(F.col("ELEMENT") == element)))
    agg = o.groupBy("COUNTRY_CODE", "YEAR").agg(F.avg(F.col("VALUE").cast("double")).alias("AVERAGE"))
    if countries is None:
        return agg
    names = countries.select(F.col("CODE").alias("COUNTRY_CODE"), "COUNTRY_NAME")
    return lookup_join(agg, names, "COUNTRY_CODE", "left")


def top_country_year(averages: DataFrame, n: int = 1) -> DataFrame:
    """Highest averages, ties broken by country then year (deterministic)."""
    return averages.orderBy(F.col("AVERAGE").desc(), "COUNTRY_CODE", "YEAR").limit(n)
