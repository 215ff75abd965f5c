"""Station dimension: enrichment, element profile, network and area counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.functions.columns import array_text, country_code
from stratus.layouts import CORE_ELEMENTS
from stratus.operators.joins import lookup_join


def with_country_code(stations: DataFrame) -> DataFrame:
    return stations.withColumn("COUNTRY_CODE", country_code("ID"))


def inventory_profile(inventory: DataFrame, core: Sequence[str] = CORE_ELEMENTS) -> DataFrame:
    """Everything the enrichment needs from the inventory, in ONE aggregate.

    Per station: first / last active year, number of distinct elements,
    the sorted element set, and the distinct core / other element counts
    (zeros, not nulls, when a station has none of a kind).  One shuffle on
    ID with map-side partial aggregation; the distinct counts are computed
    from the (small, per-station) element set, so no Expand is needed.
    """
    is_core = F.col("ELEMENT").isin(list(core))
    prof = inventory.groupBy("ID").agg(
        F.min("FIRSTYEAR").alias("Firstyear"),
        F.max("LASTYEAR").alias("Lastyear"),
        F.array_sort(F.collect_set("ELEMENT")).alias("ELEMENT_SET"),
        F.array_sort(F.collect_set(F.when(is_core, F.col("ELEMENT")))).alias("_core"),
    )
    return prof.select(
        "ID",
        "Firstyear",
        "Lastyear",
        F.size("ELEMENT_SET").cast("long").alias("ELEMENT_NUMBER"),
        "ELEMENT_SET",
        F.size("_core").cast("long").alias("num_cElement"),
        (F.size("ELEMENT_SET") - F.size("_core")).cast("long").alias("num_nElement"),
    )


def enrich_stations(
    stations: DataFrame,
    countries: DataFrame,
    states: DataFrame,
    inventory: DataFrame,
    core: Sequence[str] = CORE_ELEMENTS,
) -> DataFrame:
    """Wide station table: station + country name + state name + profile.

    The output's column names are fixed values: the enriched table's
    published schema.

    Country and state are lookups with a unique key; the profile is
    one aggregate joined on ID.  Stations without inventory keep nulls.
    """
    st = with_country_code(stations)
    st = lookup_join(st, countries.withColumnRenamed("CODE", "COUNTRY_CODE"), "COUNTRY_CODE", "left")
    st = lookup_join(st, states.withColumnRenamed("CODE", "STATE"), "STATE", "left")
    st = st.join(inventory_profile(inventory, core), "ID", "left")
    return st.select(
        F.col("ID").alias("STATION_ID"),
        "STATE",
        "COUNTRY_CODE",
        "LATITUDE",
        "LONGITUDE",
        "ELEVATION",
        "NAME",
        "GFLAG",
        "HCFLAG",
        "WMOID",
        "COUNTRY_NAME",
        "STATE_NAME",
        "Firstyear",
        "Lastyear",
        "ELEMENT_NUMBER",
        F.col("ELEMENT_SET").alias("ELEMENT_LIST"),
        "num_cElement",
        "num_nElement",
    )


def active_years(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("ID").agg(
        F.min("FIRSTYEAR").alias("first_year"), F.max("LASTYEAR").alias("last_year")
    )


def element_count(inventory: DataFrame) -> DataFrame:
    """Distinct elements per station: the size of its (bounded) element set, one shuffle."""
    return inventory.groupBy("ID").agg(F.size(F.collect_set("ELEMENT")).cast("long").alias("element_count"))


def element_list(inventory: DataFrame) -> DataFrame:
    """Sorted element set per station (array, order-stable)."""
    return inventory.groupBy("ID").agg(F.array_sort(F.collect_set("ELEMENT")).alias("element_list"))


def conditional_distinct(inventory: DataFrame, core: Sequence[str] = CORE_ELEMENTS) -> DataFrame:
    """Distinct core / other elements per station in one pass (0 when none).

    Two ``count_distinct`` would be planned with an Expand (every row
    doubled, two extra aggregation steps).  The sizes of the per-station
    element sets give the same counts with one shuffle; a set is bounded
    by the element vocabulary, however many rows a station has.
    """
    is_core = F.col("ELEMENT").isin(list(core))
    sets = inventory.groupBy("ID").agg(
        F.collect_set(F.when(is_core, F.col("ELEMENT"))).alias("_c"),
        F.collect_set(F.when(~is_core, F.col("ELEMENT"))).alias("_o"),
    )
    return sets.select(
        "ID", F.size("_c").cast("long").alias("core_count"), F.size("_o").cast("long").alias("other_count")
    )


def conditional_rows(inventory: DataFrame, core: Sequence[str] = CORE_ELEMENTS) -> DataFrame:
    """Inventory rows per station that are core / other (rows, not distinct)."""
    is_core = F.col("ELEMENT").isin(list(core))
    return inventory.groupBy("ID").agg(
        F.count_if(is_core).alias("core_rows"), F.count_if(~is_core).alias("other_rows")
    )


def stations_with_all(inventory: DataFrame, elements: Sequence[str]) -> DataFrame:
    """Stations that measured every one of ``elements`` (HAVING on distinct count)."""
    return (
        inventory.filter(F.col("ELEMENT").isin(list(elements)))
        .groupBy("ID")
        .agg(F.size(F.collect_set("ELEMENT")).alias("count"))
        .filter(F.col("count") == len(set(elements)))
        .select("ID")
    )


def stations_with_only(inventory: DataFrame, element: str) -> DataFrame:
    """Stations whose element set is exactly ``{element}``."""
    return (
        inventory.groupBy("ID")
        .agg(F.bool_and(F.col("ELEMENT") == element).alias("only"))
        .filter("only")
        .select("ID")
    )


def network_flags(enriched: DataFrame) -> DataFrame:
    """Membership of the GSN / HCN / CRN networks as 0/1 columns."""
    return enriched.select(
        "*",
        (F.col("GFLAG") == "GSN").cast("int").alias("_gsn"),
        (F.col("HCFLAG") == "HCN").cast("int").alias("_hcn"),
        (F.col("HCFLAG") == "CRN").cast("int").alias("_crn"),
    )


def station_summary(enriched: DataFrame, active_year: int) -> DataFrame:
    """All station-level counts in one scan (one row).

    Needs GFLAG, HCFLAG, WMOID, LATITUDE and Lastyear: the enriched table,
    or just the stations joined to their active years.
    """
    f = network_flags(enriched)
    member = F.col("_gsn") + F.col("_hcn") + F.col("_crn")
    return f.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("Lastyear") == active_year).alias("active"),
        F.count_if(F.col("WMOID") == "").alias("no_wmo"),
        F.count_if(F.col("_gsn") == 1).alias("gsn"),
        F.count_if(F.col("_hcn") == 1).alias("hcn"),
        F.count_if(F.col("_crn") == 1).alias("crn"),
        F.count_if(member > 1).alias("multi_network"),
        F.count_if(F.col("LATITUDE") >= 0).alias("northern"),
    )


def multi_network_stations(stations: DataFrame) -> DataFrame:
    """Stations in more than one network (counted memberships, not ``A&B|C``)."""
    f = network_flags(stations)
    return f.filter(F.col("_gsn") + F.col("_hcn") + F.col("_crn") > 1).select("ID")


def stations_per_area(
    dim: DataFrame, stations: DataFrame, station_key: str, name_col: str, count_col: str = "station_count"
) -> DataFrame:
    """Dimension-preserving station counts: every dimension row is kept,
    with a null count where no station refers to it."""
    counts = stations.groupBy(station_key).agg(F.count(F.lit(1)).alias(count_col))
    counts = counts.withColumnRenamed(station_key, "CODE")
    return dim.join(counts, "CODE", "left").select("CODE", name_col, count_col)


def name_rule(name_col: str, contains: str, not_prefix: str):
    """``contains`` but does not start with ``not_prefix`` (territory rule)."""
    c = F.col(name_col)
    return c.contains(contains) & ~c.startswith(not_prefix)


def element_list_text(inventory: DataFrame) -> DataFrame:
    return element_list(inventory).select("ID", array_text("element_list").alias("element_list"))
