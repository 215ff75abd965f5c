"""Queries on what a lake's keeper needs: content checks, order proofs, listings, zone maps, samples and previews.

Like ``mechanisms``: registered next to the questions, over the same
whole tables, each with its own SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.operators import observations as ob
from stratus.operators import pairs as pr
from stratus.operators import preview as pv
from stratus.operators import sampling as sa
from stratus.operators import stations as stn
from stratus.operators.joins import lookup_join
from stratus.plans import fixtures as fx
from stratus.plans.queries import PAIR_COUNTRY, SQL_COUNTRY_TT, SUBSET_SIZE, hav_sql, query, r6
from stratus.session import output_path
from stratus.sources import fingerprint as fp
from stratus.sources import zones as zo
from stratus.sources.daily import write_daily_archive
from stratus.sources.lake import write_observation_lake
from stratus.sources.listing import folder_totals, list_folder
from stratus.sources.order_proof import order_proof
from stratus.sources.sinks import write_csv, write_sorted

PER_COUNTRY = 3


@query(
    "sink_reconcile_content",
    "SELECT count(*) AS data_rows, count(*) AS source_rows, true AS same_rows, true AS same_content FROM fx_obs_time",
)
def sink_reconcile_content(spark, d):
    rows, path = fx.fx_obs_time(spark, d), output_path(spark, "fingerprinted")
    return fp.reconcile_content(spark, path, rows.schema, fp.write_fingerprinted(rows, path, compression="gzip"))


@query("sink_sorted_proof", "SELECT count(*) AS data_rows, true AS in_order FROM fx_obs WHERE ELEMENT IN ('TMIN', 'TMAX')")
def sink_sorted_proof(spark, d):
    tt, keys = fx.fx_obs(spark, d).filter(F.col("ELEMENT").isin("TMIN", "TMAX")), ["ID", "DATE", "ELEMENT"]
    path = write_sorted(tt, output_path(spark, "sorted-csv"), keys)
    back = spark.read.option("header", "true").schema("ID string, DATE date, ELEMENT string, VALUE double").csv(path)
    return order_proof(back, keys)


@query(
    "sample_stations_per_country",
    f"""SELECT substr(ID, 1, 2) AS COUNTRY_CODE, ID, md5(ID) AS DIGEST FROM fx_station
QUALIFY row_number() OVER (PARTITION BY substr(ID, 1, 2) ORDER BY md5(ID), ID) <= {PER_COUNTRY}""",
)
def sample_stations_per_country(spark, d):
    st = stn.with_country_code(fx.fx_station(spark, d)).select("COUNTRY_CODE", "ID")
    return sa.bottom_k(st, ["COUNTRY_CODE"], "ID", PER_COUNTRY)


def zoned_lake(obs: DataFrame, rows_per_file: int = 2000) -> str:
    """A lake of small files; country, element and day are clustered in them."""
    return write_observation_lake(obs, output_path(obs.sparkSession, "zoned-lake"), max_records_per_file=rows_per_file)


@query("zoned_country_tmin_tmax", f"SELECT ID, DATE, ELEMENT, round(VALUE, 6) AS VALUE {SQL_COUNTRY_TT}")
def zoned_country_tmin_tmax(spark, d):
    lake = zoned_lake(fx.fx_obs_l(spark, d))
    zones = zo.build_zones(spark, lake)
    can = zo.may_hold("COUNTRY_CODE", [PAIR_COUNTRY]) & zo.may_hold("ELEMENT", ["TMIN", "TMAX"])
    o = ob.country_elements(zo.read_zones(spark, lake, zones, can), PAIR_COUNTRY, ("TMIN", "TMAX"))
    return o.select("ID", "DATE", "ELEMENT", r6("VALUE").alias("VALUE"))


def touch(spark, path: str) -> None:
    """An empty file."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p).close()


@query(
    "src_full_listing",
    # one file a year, as the writer deals rows by year, and one of zero bytes that is put next to each
    """SELECT 'YEAR=' || CAST(year(DATE) AS INTEGER) AS folder, CAST(2 AS BIGINT) AS files, CAST(1 AS BIGINT) AS empty_files, true AS sized
FROM fx_obs_l GROUP BY year(DATE)
UNION ALL SELECT '', 2 * count(DISTINCT year(DATE)), count(DISTINCT year(DATE)), true FROM fx_obs_l""",
)
def src_full_listing(spark, d):
    base = write_daily_archive(fx.fx_obs_l(spark, d), output_path(spark, "listed"), by_year=True)
    for folder in list_folder(spark, base).filter("kind = 'directory' and path like 'YEAR=%'").collect():  # one per year
        touch(spark, f"{base}/{folder.path}/late.csv")
    totals = folder_totals(list_folder(spark, base).filter(~F.col("hidden")))
    return totals.select("folder", "files", "empty_files", (F.col("bytes") > 0).alias("sized"))


PREVIEW_COLUMNS, PREVIEW_ROWS, PREVIEW_WIDTH = ("ID", "NAME", "STATE", "STATE_NAME", "GFLAG", "WMOID"), 20, 12


def _cell_sql(column: str, width: int) -> str:
    text = f"coalesce({column}, 'NULL')"
    return f"CASE WHEN length({text}) > {width} THEN substr({text}, 1, {width - 3}) || '...' ELSE {text} END AS {column}"


@query(
    "preview_stations",
    f"""SELECT {", ".join(_cell_sql(c, PREVIEW_WIDTH) for c in PREVIEW_COLUMNS)} FROM (
SELECT s.*, t.STATE_NAME FROM fx_station s LEFT JOIN fx_state t ON s.STATE = t.CODE ORDER BY s.ID LIMIT {PREVIEW_ROWS}) p""",
)
def preview_stations(spark, d):
    named = lookup_join(fx.fx_station(spark, d), fx.fx_state(spark, d).withColumnRenamed("CODE", "STATE"), "STATE")
    return pv.preview(named.select(*PREVIEW_COLUMNS), ["ID"], PREVIEW_ROWS, PREVIEW_WIDTH)


@query(
    "proj_slash_name",
    f"""WITH sub AS (SELECT ID, LATITUDE, LONGITUDE FROM fx_station ORDER BY ID LIMIT {SUBSET_SIZE})
SELECT a.ID, b.ID AS ID_1, round({hav_sql('a.LATITUDE', 'a.LONGITUDE', 'b.LATITUDE', 'b.LONGITUDE')}, 6) AS "Distance/km"
FROM sub a JOIN sub b ON a.ID <> b.ID""",
)
def proj_slash_name(spark, d):
    """Written as CSV with the slash in its header, read back by that name, and sorted by it in another case."""
    subset = fx.fx_station(spark, d).orderBy("ID").limit(SUBSET_SIZE)
    path = write_csv(pr.distance_report(pr.ordered_pairs(subset)), output_path(spark, "distances-csv"))
    back = spark.read.option("header", "true").schema("ID string, ID_1 string, `Distance/km` double").csv(path)
    return back.orderBy("DISTANCE/km", "ID", "ID_1")
