"""The whole station-archive analysis on real archive files, as one job.

``load_archive`` reads the archive formats (fixed-width metadata, gzip
CSV daily files or the Parquet lake); ``analysis`` declares every
question as a lazy DataFrame; ``write_outputs`` writes the result tables.
Run it from the command line:

    python -m stratus.plans.archive --daily <dir|glob> --stations <txt> \\
        --countries <txt> --states <txt> --inventory <txt> --out <dir> \\
        [--lake <dir>] [--country NZ] [--active-year 2021]
"""

from __future__ import annotations

import argparse
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions.columns import array_text
from stratus.layouts import CORE_ELEMENTS, COUNTRY_LAYOUT, INVENTORY_LAYOUT, STATE_LAYOUT, STATION_LAYOUT
from stratus.operators import observations as ob
from stratus.operators import pairs as pr
from stratus.operators import quality as qa
from stratus.operators import stations as stn
from stratus.sources.daily import daily_rejects, read_daily_csv
from stratus.sources.fixed_width import fixed_width_rejects, parse_fixed_width, read_fixed_width
from stratus.sources.lake import prepare_observations, read_observation_lake, write_observation_lake
from stratus.sources.sinks import reconcile_csv, write_counted

# --- fixed values: the territory rule of the station questions (country
# names that contain the text but do not start with it) ---
TERRITORY_CONTAINS = "United States"
TERRITORY_NOT_PREFIX = "United States"


@dataclass
class Archive:
    daily: DataFrame
    stations: DataFrame
    countries: DataFrame
    states: DataFrame
    inventory: DataFrame
    rejects: DataFrame | None = None  # unparseable typed fields in the metadata files


def load_archive(
    spark: SparkSession,
    daily: str,
    stations: str,
    countries: str,
    states: str,
    inventory: str,
    lake: str | None = None,
    convert: bool = False,
    check_daily: bool = True,
) -> Archive:
    """Read the archive.  With ``lake`` the daily data comes from the
    YEAR-partitioned Parquet copy (written first when ``convert``).
    ``check_daily`` adds the malformed-line count of the daily files to
    ``rejects`` (one more scan of the text); malformed fields are null."""
    if lake and convert:
        write_observation_lake(read_daily_csv(spark, daily), lake)
    if lake:
        obs = read_observation_lake(spark, lake)
    else:
        obs = prepare_observations(read_daily_csv(spark, daily))
    st_text, inv_text = spark.read.text(stations), spark.read.text(inventory)
    rejects = (
        fixed_width_rejects(st_text, STATION_LAYOUT)
        .select(F.lit("stations").alias("file"), F.col("lines"), (F.col("LATITUDE_rejects") + F.col("LONGITUDE_rejects") + F.col("ELEVATION_rejects")).alias("rejected_values"))
        .unionByName(
            fixed_width_rejects(inv_text, INVENTORY_LAYOUT).select(
                F.lit("inventory").alias("file"),
                F.col("lines"),
                (F.col("LAT_rejects") + F.col("LONG_rejects") + F.col("FIRSTYEAR_rejects") + F.col("LASTYEAR_rejects")).alias("rejected_values"),
            )
        )
    )
    if check_daily:
        rejects = rejects.unionByName(
            daily_rejects(spark, daily).select(
                F.lit("daily").alias("file"), "lines", F.col("rejected_lines").alias("rejected_values")
            )
        )
    return Archive(
        daily=obs,
        stations=parse_fixed_width(st_text, STATION_LAYOUT),
        countries=read_fixed_width(spark, countries, COUNTRY_LAYOUT),
        states=read_fixed_width(spark, states, STATE_LAYOUT),
        inventory=parse_fixed_width(inv_text, INVENTORY_LAYOUT),
        rejects=rejects,
    )


@contextmanager
def shared_metadata(a: Archive) -> Iterator[Archive]:
    """``a`` with its metadata tables persisted, for questions asked inside the scope; released at its end.

    Most questions need the stations, and several the inventory and the
    lookups; each file is then read once.  The tables are dimensions and
    spill to disk where memory is short; the daily data is never persisted.
    A lost executor's part is read again.
    """
    names = ("stations", "countries", "states", "inventory")
    held = replace(a, **{n: getattr(a, n).persist(StorageLevel.MEMORY_AND_DISK) for n in names})
    try:
        yield held
    finally:
        for n in names:
            getattr(held, n).unpersist()


def analysis(
    a: Archive,
    country: str,
    active_year: int,
    core: Sequence[str] = CORE_ELEMENTS,
    only_element: str = "PRCP",
    rain_element: str = "PRCP",
    pair_elements: Sequence[str] = ("TMIN", "TMAX"),
) -> dict[str, DataFrame]:
    """Every question of the analysis as a lazy DataFrame (nothing runs yet).

    STATION_NUM_EACH_COUNTRY and STATION_NUM_STATE are fixed values: the
    published names of the two count columns.
    """
    enriched = stn.enrich_stations(a.stations, a.countries, a.states, a.inventory, core)
    st_cc = stn.with_country_code(a.stations)
    per_country = stn.stations_per_area(a.countries, st_cc, "COUNTRY_CODE", "COUNTRY_NAME", "STATION_NUM_EACH_COUNTRY")
    per_state = stn.stations_per_area(a.states, a.stations, "STATE", "STATE_NAME", "STATION_NUM_STATE")
    territories = per_country.filter(stn.name_rule("COUNTRY_NAME", TERRITORY_CONTAINS, TERRITORY_NOT_PREFIX))
    present, absent = "TMIN", "TMAX"
    missing = ob.station_days_missing(a.daily, present, absent)
    country_tt = ob.country_elements(a.daily, country, pair_elements)
    series = ob.daily_series_average(country_tt)
    rainfall = ob.country_year_average(a.daily, a.countries, rain_element)
    pairs = pr.country_pairs(st_cc, country)
    out = {
        "enriched_stations": enriched,
        "station_summary": stn.station_summary(enriched, active_year),
        "active_years": stn.active_years(a.inventory),
        "element_profile": stn.inventory_profile(a.inventory, core),
        "all_core_stations": stn.stations_with_all(a.inventory, core),
        "only_element_stations": stn.stations_with_only(a.inventory, only_element),
        "multi_network_stations": stn.multi_network_stations(a.stations),
        "stations_per_country": per_country,
        "stations_per_state": per_state,
        "territories": territories,
        "territory_total": territories.agg(F.sum("STATION_NUM_EACH_COUNTRY").cast("long").alias("total_stations")),
        "observed_missing_stations": qa.orphan_keys(a.daily, a.stations, "ID", "ID"),
        "country_pairs": pairs,
        "closest_pair": pr.closest_pair(st_cc, country),
        "observations_per_year": ob.observations_per_year(a.daily),
        "core_element_counts": ob.element_counts(a.daily, core),
        "tmin_without_tmax": missing,
        "tmin_without_tmax_stations": ob.distinct_count(missing, "ID", "station_count"),
        "country_tmin_tmax": country_tt,
        "country_series": series,
        "years_covered": ob.distinct_count(country_tt.withColumn("YEAR", F.year("DATE")), "YEAR", "year_count"),
        "rainfall": rainfall,
        "rainfall_top": ob.top_country_year(rainfall, 1),
    }
    if a.rejects is not None:
        out["parse_rejects"] = a.rejects
    return out


def write_outputs(results: dict[str, DataFrame], out: str) -> tuple[dict[str, str], dict[str, int]]:
    """Write the result tables (CSV with header): their paths, and the rows each write has seen."""
    out = out.rstrip("/")
    enriched = results["enriched_stations"].withColumn("ELEMENT_LIST", array_text("ELEMENT_LIST"))
    readings = results["country_tmin_tmax"].select("ID", "DATE", "ELEMENT", "VALUE", "MFLAG", "QFLAG", "SFLAG", "OBS_MINUTE")
    day = ["ID", "DATE", "ELEMENT"]
    plan = {
        "enriched_stations": (enriched, "enriched-stations.csv.gz", {"compression": "gzip"}),
        "stations_per_country": (results["stations_per_country"], "stations-per-country.csv", {}),
        "stations_per_state": (results["stations_per_state"], "stations-per-state.csv", {}),
        "country_pairs": (results["country_pairs"], "country-pair-distances.csv", {}),
        "country_tmin_tmax": (readings, "country-tmin-tmax.csv", {"keys": day}),
        "country_series": (results["country_series"], "country-series.csv", {"keys": day}),
        "rainfall": (results["rainfall"], "rainfall.csv", {"single": True}),
    }
    paths = {name: f"{out}/{file}" for name, (_, file, _) in plan.items()}
    rows = {name: write_counted(df, paths[name], **how) for name, (df, _, how) in plan.items()}
    return paths, rows


def reconcile_outputs(spark: SparkSession, paths: dict[str, str], rows: dict[str, int]) -> DataFrame:
    """Read every written CSV back and compare its rows with those the write
    has seen (one row per output: files, data_rows, source_rows, ok).  Gzip
    parts are read transparently."""
    out = None
    for name, path in sorted(paths.items()):
        r = reconcile_csv(spark, path, rows[name]).select(F.lit(name).alias("output"), "*")
        out = r if out is None else out.unionByName(r)
    return out


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="station archive analysis")
    for name in ("daily", "stations", "countries", "states", "inventory", "out"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--lake")
    p.add_argument("--convert", action="store_true", help="write the Parquet lake from --daily first")
    p.add_argument("--country", default="NZ")
    p.add_argument("--active-year", type=int, default=2021)
    p.add_argument("--reconcile", action="store_true", help="read the outputs back and check row counts")
    p.add_argument("--no-daily-check", action="store_true", help="do not count malformed lines of the daily files")
    p.add_argument("--work-dir", help="folder that all executors share, for intermediate tables (spark.checkpoint.dir)")
    p.add_argument("--ui", action="store_true", help="keep Spark's web UI on (off by default)")
    args = p.parse_args(argv)
    builder = SparkSession.builder.appName("stratus-archive").config("spark.ui.enabled", "true" if args.ui else "false")
    if args.work_dir:
        builder = builder.config("spark.checkpoint.dir", args.work_dir)
    spark = builder.getOrCreate()
    a = load_archive(
        spark, args.daily, args.stations, args.countries, args.states, args.inventory, args.lake, args.convert,
        not args.no_daily_check,
    )
    with shared_metadata(a) as held:
        res = analysis(held, args.country, args.active_year)
        paths, rows = write_outputs(res, args.out)
        if args.reconcile:
            reconcile_outputs(spark, paths, rows).show(truncate=False)
        for key in ("parse_rejects", "station_summary", "territory_total", "core_element_counts", "tmin_without_tmax_stations",
                    "years_covered", "closest_pair", "rainfall_top"):
            res[key].show(truncate=False)


if __name__ == "__main__":
    main()
