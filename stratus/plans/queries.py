"""One query per operator / question, each with its SQL oracle.

Every query takes ``(spark, sf_dir)``, reads the given tables (through
the fixture views) and returns a DataFrame; nothing is collected.  The
oracle SQL next to it is what DuckDB runs on the same Parquet files.
Conventions shared by both sides: counts are bigint, years int,
doubles rounded to 6 decimals, sets rendered as sorted text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions.columns import array_text, obs_minute, trimmed_piece, year_int, year_text
from stratus.functions.geo import haversine_km
from stratus.layouts import CORE_ELEMENTS, COUNTRY_LAYOUT, INVENTORY_LAYOUT, STATE_LAYOUT, STATION_LAYOUT
from stratus.operators import observations as ob
from stratus.operators import pairs as pr
from stratus.operators import quality as qa
from stratus.operators import stations as stn
from stratus.operators.joins import lookup_join
from stratus.plans import fixtures as fx
from stratus.plans.tables import table
from stratus.session import output_path
from stratus.sources.daily import read_daily_csv, read_untyped_csv, with_obs_minute, write_daily_archive
from stratus.sources.files import file_inventory, inventory_totals
from stratus.sources.fixed_width import read_fixed_width, render_fixed_width
from stratus.sources.lake import read_observation_lake, write_observation_lake
from stratus.sources.sinks import reconcile_csv, write_counted, write_csv, write_single_file, write_sorted
from stratus.streaming.ingest import ingest_daily_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = fx.with_fixtures(sql)
        return fn

    return deco


# ---------------------------------------------------------------- parameters
# Element lists of the fixture views: both use the archive's own element
# names; the inventory fixture has five of them, three of them core.
OBS_CORE = CORE_ELEMENTS
INV_CORE = ("PRCP", "SNOW", "TMIN")
ONLY_ELEMENT = "WESD"
ACTIVE_YEAR = 2001
PAIR_COUNTRY = "07"
ONE_YEAR = 2000
FIXED_POINT = (-43.5, 172.5)
TERRITORY_RULE = ("ASIA", "NATION_1")  # name contains / does not start with
SUBSET_SIZE = 10


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def hav_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Haversine in SQL (same formula and guard as functions.geo)."""
    a = (
        f"(pow(sin(radians(({lat2}) - ({lat1})) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians(({lon2}) - ({lon1})) / 2), 2))"
    )
    return f"(12742.0 * asin(sqrt(CASE WHEN {a} > 1.0 THEN 1.0 ELSE {a} END)))"


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# =============================================================== sources
@query(
    "src_daily_csv",
    "SELECT ID, DATE, ELEMENT, round(VALUE, 2) AS VALUE, MFLAG, QFLAG, SFLAG, OBS_MINUTE FROM fx_obs_time",
)
def src_daily_csv(spark, d):
    path = output_path(spark, "daily-csv")
    write_daily_archive(fx.fx_obs_time(spark, d), path, by_year=False)
    back = with_obs_minute(read_daily_csv(spark, path))
    value = F.round(F.col("VALUE").cast("double"), 2).alias("VALUE")
    return back.select("ID", "DATE", "ELEMENT", value, "MFLAG", "QFLAG", "SFLAG", "OBS_MINUTE")


def _archive_by_year(spark, d) -> str:
    path = output_path(spark, "daily-by-year")
    return write_daily_archive(fx.fx_obs_l(spark, d), path, by_year=True)


@query(
    "src_year_range",
    """SELECT CAST(year(DATE) AS INTEGER) AS YEAR, count(*) AS observation_count
FROM fx_obs_l WHERE year(DATE) BETWEEN 1998 AND 2000 GROUP BY 1""",
)
def src_year_range(spark, d):
    base = _archive_by_year(spark, d)
    # brace alternation + character class, like a glob over yearly files
    obs = read_daily_csv(spark, f"{base}/YEAR={{199[8-9],2000}}", base_path=base)
    return obs.groupBy(F.col("YEAR").cast("int").alias("YEAR")).agg(F.count(F.lit(1)).alias("observation_count"))


@query(
    "src_daily_all",
    "SELECT CAST(year(DATE) AS INTEGER) AS YEAR, count(*) AS observation_count FROM fx_obs_l GROUP BY 1",
)
def src_daily_all(spark, d):
    base = _archive_by_year(spark, d)
    obs = read_daily_csv(spark, base)
    return obs.groupBy(F.col("YEAR").cast("int").alias("YEAR")).agg(F.count(F.lit(1)).alias("observation_count"))


@query("src_untyped_csv", "SELECT CODE AS _c0, COUNTRY_NAME AS _c1 FROM fx_country")
def src_untyped_csv(spark, d):
    path = write_csv(fx.fx_country(spark, d), output_path(spark, "country-csv"), header=False)
    return read_untyped_csv(spark, path).select("_c0", "_c1")


def _fixed_width_roundtrip(spark, df, layout, name):
    path = output_path(spark, name)
    render_fixed_width(df, layout).write.mode("overwrite").text(path)
    return read_fixed_width(spark, path, layout)


@query(
    "src_fixed_width_station",
    """SELECT ID, STATE, NAME, GFLAG, HCFLAG, WMOID,
  round(LATITUDE, 2) AS LATITUDE, round(LONGITUDE, 2) AS LONGITUDE, ELEVATION FROM fx_station""",
)
def src_fixed_width_station(spark, d):
    st = _fixed_width_roundtrip(spark, fx.fx_station(spark, d), STATION_LAYOUT, "stations-txt")
    return st.select(
        "ID", "STATE", "NAME", "GFLAG", "HCFLAG", "WMOID",
        F.round(F.col("LATITUDE").cast("double"), 2).alias("LATITUDE"),
        F.round(F.col("LONGITUDE").cast("double"), 2).alias("LONGITUDE"),
        F.col("ELEVATION").cast("double").alias("ELEVATION"),
    )


@query(
    "src_fixed_width_inventory",
    "SELECT ID, round(LAT, 2) AS LAT, round(LONG, 2) AS LONG, ELEMENT, FIRSTYEAR, LASTYEAR FROM fx_inventory",
)
def src_fixed_width_inventory(spark, d):
    inv = _fixed_width_roundtrip(spark, fx.fx_inventory(spark, d), INVENTORY_LAYOUT, "inventory-txt")
    place = [F.round(F.col(c).cast("double"), 2).alias(c) for c in ("LAT", "LONG")]
    return inv.select("ID", *place, "ELEMENT", "FIRSTYEAR", "LASTYEAR")


@query("src_fixed_width_lookup", "SELECT CODE, COUNTRY_NAME FROM fx_country")
def src_fixed_width_lookup(spark, d):
    return _fixed_width_roundtrip(spark, fx.fx_country(spark, d), COUNTRY_LAYOUT, "countries-txt")


@query("src_fixed_width_state", "SELECT CODE, STATE_NAME FROM fx_state")
def src_fixed_width_state(spark, d):
    return _fixed_width_roundtrip(spark, fx.fx_state(spark, d), STATE_LAYOUT, "states-txt")


@query(
    "src_file_inventory",
    # file names and sizes depend on the writer; files and rows per year, and their totals, do not
    """SELECT CAST(year(DATE) AS INTEGER) AS YEAR, CAST(1 AS BIGINT) AS files, count(*) AS rows, true AS sized FROM fx_obs_l GROUP BY 1
UNION ALL SELECT NULL, count(DISTINCT year(DATE)), count(*), true FROM fx_obs_l""",
)
def src_file_inventory(spark, d):
    files = file_inventory(spark, _archive_by_year(spark, d), count_rows="csv")
    files = files.withColumn("YEAR", F.regexp_extract("file_path", "YEAR=([0-9]+)", 1).cast("int"))
    per_year = files.groupBy("YEAR").agg(
        F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("rows"), F.bool_and(F.col("file_bytes") > 0).alias("sized")
    )
    totals = inventory_totals(files).select(F.lit(None).cast("int").alias("YEAR"), "files", "rows", (F.col("bytes") > 0).alias("sized"))
    return per_year.unionByName(totals)


@query(
    "parse_obs_time",
    """WITH e AS (SELECT event_id, lpad(CAST(event_id % 2500 AS VARCHAR), 4, '0') AS t FROM events),
p AS (SELECT event_id, t, TRY_CAST(substr(t, 1, 2) AS INTEGER) AS hh, TRY_CAST(substr(t, 3, 2) AS INTEGER) AS mm FROM e)
SELECT event_id,
  CASE WHEN regexp_full_match(t, '[0-9]{4}') AND mm < 60 AND (hh < 24 OR (hh = 24 AND mm = 0))
       THEN CAST(hh * 60 + mm AS INTEGER) END AS OBS_MINUTE
FROM p""",
)
def parse_obs_time(spark, d):
    ev = table(spark, d, "events")
    t = F.lpad((F.col("event_id") % 2500).cast("string"), 4, "0")
    return ev.select("event_id", obs_minute(t).alias("OBS_MINUTE"))


# ================================================================= sinks
def _enriched(spark, d) -> DataFrame:
    return stn.enrich_stations(
        fx.fx_station(spark, d), fx.fx_country(spark, d), fx.fx_state(spark, d), fx.fx_inventory(spark, d), INV_CORE
    )


def _stations_per_country(spark, d) -> DataFrame:
    st = stn.with_country_code(fx.fx_station(spark, d))
    return stn.stations_per_area(fx.fx_country(spark, d), st, "COUNTRY_CODE", "COUNTRY_NAME")


SQL_PER_COUNTRY = """SELECT c.CODE, c.COUNTRY_NAME, n.station_count FROM fx_country c LEFT JOIN
(SELECT substr(ID, 1, 2) AS CODE, count(*) AS station_count FROM fx_station GROUP BY 1) n ON c.CODE = n.CODE"""


@query("sink_csv_roundtrip", SQL_PER_COUNTRY)
def sink_csv_roundtrip(spark, d):
    path = write_csv(_stations_per_country(spark, d), output_path(spark, "per-country-csv"))
    schema = "CODE string, COUNTRY_NAME string, station_count bigint"
    return spark.read.option("header", "true").schema(schema).csv(path)


@query(
    "sink_sorted",
    "SELECT ID, DATE, ELEMENT, round(VALUE, 6) AS VALUE FROM fx_obs WHERE ELEMENT IN ('TMIN', 'TMAX')",
)
def sink_sorted(spark, d):
    tt = fx.fx_obs(spark, d).filter(F.col("ELEMENT").isin("TMIN", "TMAX"))
    path = write_sorted(tt, output_path(spark, "sorted-csv"), ["ID", "DATE", "ELEMENT"])
    back = spark.read.option("header", "true").schema("ID string, DATE date, ELEMENT string, VALUE double").csv(path)
    return back.select("ID", "DATE", "ELEMENT", r6("VALUE").alias("VALUE"))


def _rainfall(spark, d) -> DataFrame:
    return ob.country_year_average(fx.fx_obs_l(spark, d), fx.fx_country(spark, d), "PRCP")


SQL_RAINFALL_INNER = """SELECT substr(ID, 1, 2) AS COUNTRY_CODE, CAST(year(DATE) AS INTEGER) AS YEAR, avg(VALUE) AS AVERAGE
FROM fx_obs_l WHERE ELEMENT = 'PRCP' GROUP BY 1, 2"""
SQL_RAINFALL = f"""SELECT r.COUNTRY_CODE, r.YEAR, round(r.AVERAGE, 6) AS AVERAGE, c.COUNTRY_NAME
FROM ({SQL_RAINFALL_INNER}) r LEFT JOIN fx_country c ON r.COUNTRY_CODE = c.CODE"""


@query("sink_single_file", SQL_RAINFALL)
def sink_single_file(spark, d):
    r = _rainfall(spark, d).select("COUNTRY_CODE", "YEAR", "AVERAGE", "COUNTRY_NAME")
    path = write_single_file(r, output_path(spark, "rainfall-one-file"))
    schema = "COUNTRY_CODE string, YEAR int, AVERAGE double, COUNTRY_NAME string"
    back = spark.read.option("header", "true").schema(schema).csv(path)
    return back.select("COUNTRY_CODE", "YEAR", r6("AVERAGE").alias("AVERAGE"), "COUNTRY_NAME")


@query(
    "sink_reconcile",
    # three part files (explicit repartition(3), kept by AQE)
    "SELECT CAST(3 AS BIGINT) AS files, count(*) AS data_rows, count(*) AS source_rows, true AS ok FROM fx_country",
)
def sink_reconcile(spark, d):
    path = output_path(spark, "country-3-parts")
    rows = write_counted(fx.fx_country(spark, d).repartition(3), path)
    return reconcile_csv(spark, path, rows)


# ========================================================== projections
@query(
    "proj_select_alias",
    "SELECT ID AS STATION_ID, round(LATITUDE, 6) AS LAT, round(LONGITUDE, 6) AS LON FROM fx_station",
)
def proj_select_alias(spark, d):
    return fx.fx_station(spark, d).select(
        F.col("ID").alias("STATION_ID"), r6("LATITUDE").alias("LAT"), r6("LONGITUDE").alias("LON")
    )


@query("proj_typed_cast", "SELECT c_custkey, TRY_CAST(substr(c_name, 10, 9) AS INTEGER) AS num FROM customer")
def proj_typed_cast(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", F.substring("c_name", 10, 9).try_cast("int").alias("num"))


@query("proj_country_code", "SELECT ID, substr(ID, 1, 2) AS COUNTRY_CODE FROM fx_station")
def proj_country_code(spark, d):
    return stn.with_country_code(fx.fx_station(spark, d)).select("ID", "COUNTRY_CODE")


@query("proj_rename", "SELECT CODE AS COUNTRY_CODE, COUNTRY_NAME FROM fx_country")
def proj_rename(spark, d):
    # renaming a column that is not there ("NAME") is a no-op, as in Spark
    return fx.fx_country(spark, d).withColumnRenamed("CODE", "COUNTRY_CODE").withColumnRenamed("NAME", "COUNTRY_NAME")


@query("fn_substring_trim", "SELECT c_custkey, trim(substr(lpad(c_mktsegment, 12, ' '), 3, 4)) AS piece FROM customer")
def fn_substring_trim(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", trimmed_piece(F.lpad("c_mktsegment", 12, " "), 3, 4).alias("piece"))


@query(
    "fn_year",
    "SELECT DISTINCT CAST(year(DATE) AS INTEGER) AS YEAR, substr(CAST(DATE AS VARCHAR), 1, 4) AS YEAR_TEXT FROM fx_obs_l",
)
def fn_year(spark, d):
    return fx.fx_obs_l(spark, d).select(year_int("DATE").alias("YEAR"), year_text("DATE").alias("YEAR_TEXT")).distinct()


@query(
    "fn_array_to_string",
    """SELECT ID, '[' || array_to_string(list_sort(list_distinct(list(ELEMENT))), ', ') || ']' AS element_list
FROM fx_inventory GROUP BY ID""",
)
def fn_array_to_string(spark, d):
    lst = stn.element_list(fx.fx_inventory(spark, d))
    return lst.select("ID", F.concat(F.lit("["), array_text("element_list", ", "), F.lit("]")).alias("element_list"))


# ============================================================== filters
@query("flt_blank_string", "SELECT ID FROM fx_station WHERE WMOID = ''")
def flt_blank_string(spark, d):
    return fx.fx_station(spark, d).filter(F.col("WMOID") == "").select("ID")


@query("flt_equality", "SELECT ID FROM fx_station WHERE GFLAG = 'GSN'")
def flt_equality(spark, d):
    return fx.fx_station(spark, d).filter(F.col("GFLAG") == "GSN").select("ID")


@query("flt_isin", f"SELECT ID, DATE, ELEMENT, round(VALUE, 6) AS VALUE FROM fx_obs WHERE ELEMENT IN {_in(OBS_CORE)}")
def flt_isin(spark, d):
    o = fx.fx_obs(spark, d).filter(F.col("ELEMENT").isin(list(OBS_CORE)))
    return o.select("ID", "DATE", "ELEMENT", r6("VALUE").alias("VALUE"))


@query(
    "flt_not_isin", f"SELECT ID, DATE, ELEMENT, round(VALUE, 6) AS VALUE FROM fx_obs WHERE ELEMENT NOT IN {_in(OBS_CORE)}"
)
def flt_not_isin(spark, d):
    o = fx.fx_obs(spark, d).filter(~F.col("ELEMENT").isin(list(OBS_CORE)))
    return o.select("ID", "DATE", "ELEMENT", r6("VALUE").alias("VALUE"))


@query("flt_and_or_not", "SELECT ID FROM fx_station WHERE (GFLAG = 'GSN' AND HCFLAG = 'HCN') OR NOT (STATE = '')")
def flt_and_or_not(spark, d):
    c = F.col
    return fx.fx_station(spark, d).filter(((c("GFLAG") == "GSN") & (c("HCFLAG") == "HCN")) | ~(c("STATE") == "")).select("ID")


@query("flt_range_lat", "SELECT ID, round(LATITUDE, 6) AS LATITUDE FROM fx_station WHERE LATITUDE >= 0")
def flt_range_lat(spark, d):
    return fx.fx_station(spark, d).filter(F.col("LATITUDE") >= 0).select("ID", r6("LATITUDE").alias("LATITUDE"))


@query(
    "flt_contains_not_startswith",
    f"""SELECT CODE, COUNTRY_NAME FROM fx_country
WHERE contains(COUNTRY_NAME, '{TERRITORY_RULE[0]}') AND NOT starts_with(COUNTRY_NAME, '{TERRITORY_RULE[1]}')""",
)
def flt_contains_not_startswith(spark, d):
    return fx.fx_country(spark, d).filter(stn.name_rule("COUNTRY_NAME", *TERRITORY_RULE))


# ================================================================ joins
@query(
    "join_left_country",
    "SELECT s.ID AS STATION_ID, c.COUNTRY_NAME FROM fx_station s LEFT JOIN fx_country c ON substr(s.ID, 1, 2) = c.CODE",
)
def join_left_country(spark, d):
    e = _enriched(spark, d)
    return e.select("STATION_ID", "COUNTRY_NAME")


@query(
    "join_left_state",
    "SELECT s.ID AS STATION_ID, st.STATE_NAME FROM fx_station s LEFT JOIN fx_state st ON s.STATE = st.CODE",
)
def join_left_state(spark, d):
    st = fx.fx_station(spark, d)
    j = lookup_join(st, fx.fx_state(spark, d).withColumnRenamed("CODE", "STATE"), "STATE", "left")
    return j.select(F.col("ID").alias("STATION_ID"), "STATE_NAME")


@query("join_left_anti", "SELECT s.ID FROM fx_station s WHERE NOT EXISTS (SELECT 1 FROM fx_obs o WHERE o.ID = s.ID)")
def join_left_anti(spark, d):
    return qa.orphans(fx.fx_station(spark, d), fx.fx_obs(spark, d), "ID", "ID").select("ID")


@query(
    "join_left_anti_distinct",
    "SELECT DISTINCT ID FROM fx_station EXCEPT SELECT DISTINCT ID FROM fx_obs",
)
def join_left_anti_distinct(spark, d):
    return qa.orphan_keys(fx.fx_station(spark, d), fx.fx_obs(spark, d), "ID", "ID")


@query(
    "join_left_count_check",
    """SELECT count(*) AS total_rows, count(s.ID) AS matched_rows
FROM fx_obs o LEFT JOIN (SELECT DISTINCT ID FROM fx_station) s ON o.ID = s.ID""",
)
def join_left_count_check(spark, d):
    return qa.match_count(fx.fx_obs(spark, d), fx.fx_station(spark, d), "ID", "ID")


def _subset(spark, d) -> DataFrame:
    """The k lowest station ids: a bounded top-k (the operator's feature)."""
    return fx.fx_station(spark, d).orderBy("ID").limit(SUBSET_SIZE)


@query(
    "join_cross_self",
    f"""WITH sub AS (SELECT ID, LATITUDE, LONGITUDE FROM fx_station ORDER BY ID LIMIT {SUBSET_SIZE})
SELECT a.ID, b.ID AS ID_1, round({hav_sql('a.LATITUDE', 'a.LONGITUDE', 'b.LATITUDE', 'b.LONGITUDE')}, 6) AS distance_km
FROM sub a JOIN sub b ON a.ID <> b.ID""",
)
def join_cross_self(spark, d):
    p = pr.ordered_pairs(_subset(spark, d))
    return p.select("ID", "ID_1", r6("distance_km").alias("distance_km"))


@query(
    "join_cross_subsets",
    f"""WITH west AS (SELECT * FROM fx_station WHERE LONGITUDE < 25 ORDER BY ID LIMIT {SUBSET_SIZE}),
east AS (SELECT * FROM fx_station WHERE LONGITUDE > 30 ORDER BY ID LIMIT {SUBSET_SIZE})
SELECT a.ID, b.ID AS ID_1, round({hav_sql('a.LATITUDE', 'a.LONGITUDE', 'b.LATITUDE', 'b.LONGITUDE')}, 6) AS distance_km
FROM west a JOIN east b ON a.ID <> b.ID""",
)
def join_cross_subsets(spark, d):
    st = fx.fx_station(spark, d)
    west = st.filter(F.col("LONGITUDE") < 25).orderBy("ID").limit(SUBSET_SIZE)
    east = st.filter(F.col("LONGITUDE") > 30).orderBy("ID").limit(SUBSET_SIZE)
    p = pr.two_set_pairs(west, east)
    return p.select("ID", "ID_1", r6("distance_km").alias("distance_km"))


# ========================================================== aggregates
@query(
    "agg_count_all",
    """SELECT 'fx_station' AS table_name, count(*) AS row_count FROM fx_station
UNION ALL SELECT 'fx_country', count(*) FROM fx_country
UNION ALL SELECT 'fx_state', count(*) FROM fx_state
UNION ALL SELECT 'fx_inventory', count(*) FROM fx_inventory
UNION ALL SELECT 'fx_obs', count(*) FROM fx_obs""",
)
def agg_count_all(spark, d):
    parts = [
        ("fx_station", fx.fx_station),
        ("fx_country", fx.fx_country),
        ("fx_state", fx.fx_state),
        ("fx_inventory", fx.fx_inventory),
        ("fx_obs", fx.fx_obs),
    ]
    out = None
    for name, fn in parts:
        c = fn(spark, d).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


SQL_COND_DISTINCT = f"""SELECT ID,
  count(DISTINCT CASE WHEN ELEMENT IN {_in(INV_CORE)} THEN ELEMENT END) AS core_count,
  count(DISTINCT CASE WHEN ELEMENT NOT IN {_in(INV_CORE)} THEN ELEMENT END) AS other_count
FROM fx_inventory GROUP BY ID"""


@query(
    "agg_conditional_distinct",
    f"SELECT s.ID, p.core_count, p.other_count FROM fx_station s LEFT JOIN ({SQL_COND_DISTINCT}) p ON s.ID = p.ID",
)
def agg_conditional_distinct(spark, d):
    prof = stn.conditional_distinct(fx.fx_inventory(spark, d), INV_CORE)
    return fx.fx_station(spark, d).select("ID").join(prof, "ID", "left")


@query(
    "agg_conditional_sum",
    f"""SELECT ID, CAST(sum(CASE WHEN ELEMENT IN {_in(INV_CORE)} THEN 1 ELSE 0 END) AS BIGINT) AS core_rows,
  CAST(sum(CASE WHEN ELEMENT IN {_in(INV_CORE)} THEN 0 ELSE 1 END) AS BIGINT) AS other_rows
FROM fx_inventory GROUP BY ID""",
)
def agg_conditional_sum(spark, d):
    return stn.conditional_rows(fx.fx_inventory(spark, d), INV_CORE)


@query(
    "agg_having",
    f"""SELECT ID FROM fx_inventory WHERE ELEMENT IN {_in(INV_CORE)}
GROUP BY ID HAVING count(DISTINCT ELEMENT) = {len(INV_CORE)}""",
)
def agg_having(spark, d):
    return stn.stations_with_all(fx.fx_inventory(spark, d), INV_CORE)


@query(
    "agg_only_element",
    f"SELECT ID FROM fx_inventory GROUP BY ID HAVING bool_and(ELEMENT = '{ONLY_ELEMENT}')",
)
def agg_only_element(spark, d):
    return stn.stations_with_only(fx.fx_inventory(spark, d), ONLY_ELEMENT)


@query(
    "station_active_years",
    "SELECT ID, min(FIRSTYEAR) AS first_year, max(LASTYEAR) AS last_year FROM fx_inventory GROUP BY ID",
)
def station_active_years(spark, d):
    return stn.active_years(fx.fx_inventory(spark, d))


@query("station_element_count", "SELECT ID, count(DISTINCT ELEMENT) AS element_count FROM fx_inventory GROUP BY ID")
def station_element_count(spark, d):
    return stn.element_count(fx.fx_inventory(spark, d))


@query(
    "station_element_list",
    "SELECT ID, array_to_string(list_sort(list_distinct(list(ELEMENT))), ',') AS element_list FROM fx_inventory GROUP BY ID",
)
def station_element_list(spark, d):
    return stn.element_list_text(fx.fx_inventory(spark, d))


SQL_NET_COUNT = (
    "(CASE WHEN GFLAG = 'GSN' THEN 1 ELSE 0 END + CASE WHEN HCFLAG = 'HCN' THEN 1 ELSE 0 END"
    " + CASE WHEN HCFLAG = 'CRN' THEN 1 ELSE 0 END)"
)


@query(
    "station_summary",
    f"""WITH prof AS (SELECT ID, max(LASTYEAR) AS Lastyear FROM fx_inventory GROUP BY ID)
SELECT count(*) AS total, CAST(count_if(p.Lastyear = {ACTIVE_YEAR}) AS BIGINT) AS active_{ACTIVE_YEAR},
  CAST(count_if(WMOID = '') AS BIGINT) AS no_wmo, CAST(count_if(GFLAG = 'GSN') AS BIGINT) AS gsn,
  CAST(count_if(HCFLAG = 'HCN') AS BIGINT) AS hcn, CAST(count_if(HCFLAG = 'CRN') AS BIGINT) AS crn,
  CAST(count_if({SQL_NET_COUNT} > 1) AS BIGINT) AS multi_network,
  CAST(count_if(LATITUDE >= 0) AS BIGINT) AS northern
FROM fx_station s LEFT JOIN prof p ON s.ID = p.ID""",
)
def station_summary(spark, d):
    # only Lastyear is needed from the enrichment: stations + active years
    st = fx.fx_station(spark, d).join(
        stn.active_years(fx.fx_inventory(spark, d)).withColumnRenamed("last_year", "Lastyear"), "ID", "left"
    )
    return stn.station_summary(st, ACTIVE_YEAR).withColumnRenamed("active", f"active_{ACTIVE_YEAR}")


@query("station_multi_network", f"SELECT ID FROM fx_station WHERE {SQL_NET_COUNT} > 1")
def station_multi_network(spark, d):
    return stn.multi_network_stations(fx.fx_station(spark, d))


SQL_PROFILE = f"""SELECT ID, min(FIRSTYEAR) AS Firstyear, max(LASTYEAR) AS Lastyear,
    count(DISTINCT ELEMENT) AS ELEMENT_NUMBER,
    array_to_string(list_sort(list_distinct(list(ELEMENT))), ',') AS ELEMENT_LIST,
    count(DISTINCT CASE WHEN ELEMENT IN {_in(INV_CORE)} THEN ELEMENT END) AS num_cElement,
    count(DISTINCT CASE WHEN ELEMENT NOT IN {_in(INV_CORE)} THEN ELEMENT END) AS num_nElement
  FROM fx_inventory GROUP BY ID"""


SQL_ENRICHED = f"""WITH prof AS ({SQL_PROFILE})
SELECT s.ID AS STATION_ID, s.STATE, substr(s.ID, 1, 2) AS COUNTRY_CODE,
  round(s.LATITUDE, 6) AS LATITUDE, round(s.LONGITUDE, 6) AS LONGITUDE, round(s.ELEVATION, 6) AS ELEVATION,
  s.NAME, s.GFLAG, s.HCFLAG, s.WMOID, c.COUNTRY_NAME, st.STATE_NAME,
  p.Firstyear, p.Lastyear, p.ELEMENT_NUMBER, p.ELEMENT_LIST, p.num_cElement, p.num_nElement
FROM fx_station s
LEFT JOIN fx_country c ON substr(s.ID, 1, 2) = c.CODE
LEFT JOIN fx_state st ON s.STATE = st.CODE
LEFT JOIN prof p ON s.ID = p.ID"""


def _enriched_text(e: DataFrame) -> DataFrame:
    """The enriched table with its list as text and its floats rounded."""
    return e.select(
        *[
            r6(c).alias(c) if c in ("LATITUDE", "LONGITUDE", "ELEVATION")
            else array_text("ELEMENT_LIST").alias(c) if c == "ELEMENT_LIST"
            else F.col(c)
            for c in e.columns
        ]
    )


@query("enrich_stations", SQL_ENRICHED)
def enrich_stations(spark, d):
    return _enriched_text(_enriched(spark, d))


@query("sink_csv_gzip_roundtrip", SQL_ENRICHED)
def sink_csv_gzip_roundtrip(spark, d):
    """All 18 columns through gzip CSV: blank and null texts, lists, floats and counts."""
    ready = _enriched_text(_enriched(spark, d))
    path = write_csv(ready, output_path(spark, "enriched-csv-gz"), compression="gzip", null_text="\\N")
    return spark.read.option("header", "true").option("nullValue", "\\N").schema(ready.schema).csv(path)


@query("stations_per_country", SQL_PER_COUNTRY)
def stations_per_country(spark, d):
    return _stations_per_country(spark, d)


@query(
    "stations_per_state",
    """SELECT st.CODE, st.STATE_NAME, n.station_count FROM fx_state st LEFT JOIN
(SELECT STATE AS CODE, count(*) AS station_count FROM fx_station GROUP BY STATE) n ON st.CODE = n.CODE""",
)
def stations_per_state(spark, d):
    return stn.stations_per_area(fx.fx_state(spark, d), fx.fx_station(spark, d), "STATE", "STATE_NAME")


@query(
    "territory_station_total",
    f"""SELECT CAST(sum(station_count) AS BIGINT) AS total_stations FROM ({SQL_PER_COUNTRY}) t
WHERE contains(COUNTRY_NAME, '{TERRITORY_RULE[0]}') AND NOT starts_with(COUNTRY_NAME, '{TERRITORY_RULE[1]}')""",
)
def territory_station_total(spark, d):
    per = _stations_per_country(spark, d).filter(stn.name_rule("COUNTRY_NAME", *TERRITORY_RULE))
    return per.agg(F.sum("station_count").cast("long").alias("total_stations"))


@query(
    "inventory_extremes",
    """(SELECT 'earliest' AS kind, ID, ELEMENT, FIRSTYEAR, LASTYEAR FROM fx_inventory ORDER BY FIRSTYEAR, ID, ELEMENT LIMIT 1)
UNION ALL
(SELECT 'latest' AS kind, ID, ELEMENT, FIRSTYEAR, LASTYEAR FROM fx_inventory ORDER BY LASTYEAR DESC, ID, ELEMENT LIMIT 1)""",
)
def inventory_extremes(spark, d):
    inv = fx.fx_inventory(spark, d)
    cols = ["ID", "ELEMENT", "FIRSTYEAR", "LASTYEAR"]
    first = inv.orderBy("FIRSTYEAR", "ID", "ELEMENT").limit(1).select(F.lit("earliest").alias("kind"), *cols)
    last = inv.orderBy(F.col("LASTYEAR").desc(), "ID", "ELEMENT").limit(1).select(F.lit("latest").alias("kind"), *cols)
    return first.unionByName(last)


@query(
    "limit_ordered",
    f"""SELECT ID, round(LATITUDE, 6) AS LATITUDE, round(LONGITUDE, 6) AS LONGITUDE
FROM fx_station ORDER BY ID LIMIT {SUBSET_SIZE}""",
)
def limit_ordered(spark, d):
    return _subset(spark, d).select("ID", r6("LATITUDE").alias("LATITUDE"), r6("LONGITUDE").alias("LONGITUDE"))


# ============================================================= set ops
@query(
    "set_except_tmin_tmax",
    "SELECT ID, DATE FROM fx_obs WHERE ELEMENT = 'TMIN' EXCEPT SELECT ID, DATE FROM fx_obs WHERE ELEMENT = 'TMAX'",
)
def set_except_tmin_tmax(spark, d):
    return ob.station_days_except(fx.fx_obs(spark, d), "TMIN", "TMAX")


@query("set_distinct", "SELECT DISTINCT ID, ELEMENT FROM fx_obs")
def set_distinct(spark, d):
    return fx.fx_obs(spark, d).select("ID", "ELEMENT").distinct()


# ======================================================== observations
SQL_PER_YEAR = "SELECT CAST(year(DATE) AS INTEGER) AS YEAR, count(*) AS observation_count FROM fx_obs_l GROUP BY 1"


@query(
    "stream_ingest_daily",
    """SELECT substr(ID, 1, 2) AS COUNTRY_CODE, CAST(year(DATE) AS INTEGER) AS YEAR, OBS_MINUTE, SFLAG, count(*) AS observation_count
FROM fx_obs_time GROUP BY ALL""",
)
def stream_ingest_daily(spark, d):
    """Archive files -> streaming ingest -> lake -> observations per derived key."""
    src = output_path(spark, "stream-src")
    write_daily_archive(fx.fx_obs_time(spark, d), src, by_year=False)
    lake = output_path(spark, "stream-lake")
    ingest_daily_stream(spark, src, lake, output_path(spark, "stream-ckpt"))
    obs = read_observation_lake(spark, lake)
    return obs.groupBy("COUNTRY_CODE", "YEAR", "OBS_MINUTE", "SFLAG").agg(F.count(F.lit(1)).alias("observation_count"))


@query("obs_per_year", SQL_PER_YEAR)
def obs_per_year(spark, d):
    return ob.observations_per_year(fx.fx_obs_l(spark, d))


@query(
    "core_element_counts",
    f"SELECT ELEMENT, count(ELEMENT) AS observation_count FROM fx_obs WHERE ELEMENT IN {_in(OBS_CORE)} GROUP BY ELEMENT",
)
def core_element_counts(spark, d):
    return ob.element_counts(fx.fx_obs(spark, d), OBS_CORE)


SQL_TMIN_ONLY = """SELECT ID, DATE FROM fx_obs WHERE ELEMENT IN ('TMIN', 'TMAX') GROUP BY ID, DATE
HAVING bool_or(ELEMENT = 'TMIN') AND NOT bool_or(ELEMENT = 'TMAX')"""


@query("tmin_without_tmax", SQL_TMIN_ONLY)
def tmin_without_tmax(spark, d):
    return ob.station_days_missing(fx.fx_obs(spark, d), "TMIN", "TMAX")


@query("tmin_without_tmax_stations", f"SELECT count(DISTINCT ID) AS station_count FROM ({SQL_TMIN_ONLY}) t")
def tmin_without_tmax_stations(spark, d):
    return ob.distinct_count(ob.station_days_missing(fx.fx_obs(spark, d), "TMIN", "TMAX"), "ID", "station_count")


SQL_COUNTRY_TT = f"FROM fx_obs_l WHERE substr(ID, 1, 2) = '{PAIR_COUNTRY}' AND ELEMENT IN ('TMIN', 'TMAX')"


@query("country_tmin_tmax", f"SELECT ID, DATE, ELEMENT, round(VALUE, 6) AS VALUE {SQL_COUNTRY_TT}")
def country_tmin_tmax(spark, d):
    o = ob.country_elements(fx.fx_obs_l(spark, d), PAIR_COUNTRY, ("TMIN", "TMAX"))
    return o.select("ID", "DATE", "ELEMENT", r6("VALUE").alias("VALUE"))


@query("years_covered", f"SELECT count(DISTINCT year(DATE)) AS year_count {SQL_COUNTRY_TT}")
def years_covered(spark, d):
    # distinct years straight from the rows: the per-day averaging of the
    # series does not change which years occur, so it is not needed here
    obs = ob.country_elements(fx.fx_obs_l(spark, d), PAIR_COUNTRY, ("TMIN", "TMAX"))
    return ob.distinct_count(obs.withColumn("YEAR", year_int("DATE")), "YEAR", "year_count")


@query(
    "daily_series_avg",
    f"""SELECT ID, DATE, ELEMENT, round(avg(VALUE), 6) AS AVERAGE, CAST(year(DATE) AS INTEGER) AS YEAR
{SQL_COUNTRY_TT} GROUP BY ID, DATE, ELEMENT""",
)
def daily_series_avg(spark, d):
    s = ob.daily_series_average(ob.country_elements(fx.fx_obs_l(spark, d), PAIR_COUNTRY, ("TMIN", "TMAX")))
    return s.select("ID", "DATE", "ELEMENT", r6("AVERAGE").alias("AVERAGE"), "YEAR")


@query("rainfall_country_year", SQL_RAINFALL)
def rainfall_country_year(spark, d):
    r = _rainfall(spark, d)
    return r.select("COUNTRY_CODE", "YEAR", r6("AVERAGE").alias("AVERAGE"), "COUNTRY_NAME")


@query(
    "rainfall_top_country_year",
    f"""SELECT r.COUNTRY_CODE, r.YEAR, round(r.AVERAGE, 6) AS AVERAGE, c.COUNTRY_NAME
FROM ({SQL_RAINFALL_INNER}) r LEFT JOIN fx_country c ON r.COUNTRY_CODE = c.CODE
ORDER BY r.AVERAGE DESC, r.COUNTRY_CODE, r.YEAR LIMIT 1""",
)
def rainfall_top_country_year(spark, d):
    top = ob.top_country_year(_rainfall(spark, d), 1)
    return top.select("COUNTRY_CODE", "YEAR", r6("AVERAGE").alias("AVERAGE"), "COUNTRY_NAME")


SQL_ONE_YEAR = f"""SELECT r.COUNTRY_CODE, c.COUNTRY_NAME, round(r.AVERAGE, 6) AS AVERAGE
FROM ({SQL_RAINFALL_INNER}) r LEFT JOIN fx_country c ON r.COUNTRY_CODE = c.CODE WHERE r.YEAR = {ONE_YEAR}"""


@query("rainfall_country_one_year", SQL_ONE_YEAR)
def rainfall_country_one_year(spark, d):
    # a range of dates, not a year computed per row: sources can push it down
    day = F.col("DATE")
    obs = fx.fx_obs_l(spark, d).filter(day.between(F.make_date(F.lit(ONE_YEAR), F.lit(1), F.lit(1)), F.make_date(F.lit(ONE_YEAR), F.lit(12), F.lit(31))))
    r = ob.country_year_average(obs, fx.fx_country(spark, d), "PRCP")
    return r.select("COUNTRY_CODE", "COUNTRY_NAME", r6("AVERAGE").alias("AVERAGE"))


@query("lake_rainfall_one_year", SQL_ONE_YEAR)
def lake_rainfall_one_year(spark, d):
    """Same question answered from the YEAR-partitioned Parquet lake:
    the YEAR filter prunes directories, ELEMENT is a pushed filter."""
    path = write_observation_lake(fx.fx_obs_l(spark, d), output_path(spark, "obs-lake"))
    obs = read_observation_lake(spark, path).filter(F.col("YEAR") == ONE_YEAR)
    r = ob.country_year_average(obs, fx.fx_country(spark, d), "PRCP")
    return r.select("COUNTRY_CODE", "COUNTRY_NAME", r6("AVERAGE").alias("AVERAGE"))


# ================================================================= geo
@query(
    "geo_haversine",
    f"SELECT ID, round({hav_sql('LATITUDE', 'LONGITUDE', str(FIXED_POINT[0]), str(FIXED_POINT[1]))}, 6) AS distance_km FROM fx_station",
)
def geo_haversine(spark, d):
    st = fx.fx_station(spark, d)
    dist = haversine_km("LATITUDE", "LONGITUDE", F.lit(FIXED_POINT[0]), F.lit(FIXED_POINT[1]))
    return st.select("ID", r6(dist).alias("distance_km"))


SQL_PAIRS = f"""SELECT a.ID, b.ID AS ID_1, {hav_sql('a.LATITUDE', 'a.LONGITUDE', 'b.LATITUDE', 'b.LONGITUDE')} AS d
FROM fx_station a JOIN fx_station b ON substr(a.ID, 1, 2) = substr(b.ID, 1, 2) AND a.ID < b.ID
WHERE substr(a.ID, 1, 2) = '{PAIR_COUNTRY}'"""


@query("geo_country_pairs", f"SELECT ID, ID_1, round(d, 6) AS distance_km FROM ({SQL_PAIRS}) p")
def geo_country_pairs(spark, d):
    st = stn.with_country_code(fx.fx_station(spark, d))
    p = pr.country_pairs(st, PAIR_COUNTRY)
    return p.select("ID", "ID_1", r6("distance_km").alias("distance_km"))


@query(
    "geo_all_country_pairs",
    f"""SELECT substr(a.ID, 1, 2) AS COUNTRY_CODE, count(*) AS pairs,
  round(min({hav_sql('a.LATITUDE', 'a.LONGITUDE', 'b.LATITUDE', 'b.LONGITUDE')}), 6) AS nearest_km
FROM fx_station a JOIN fx_station b ON substr(a.ID, 1, 2) = substr(b.ID, 1, 2) AND a.ID < b.ID GROUP BY 1""",
)
def geo_all_country_pairs(spark, d):
    p = pr.pair_summary(stn.with_country_code(fx.fx_station(spark, d)))
    return p.select("COUNTRY_CODE", "pairs", r6("nearest_km").alias("nearest_km"))


@query(
    "geo_closest_pair",
    f"SELECT ID, ID_1, round(d, 6) AS distance_km FROM ({SQL_PAIRS}) p ORDER BY d, ID, ID_1 LIMIT 1",
)
def geo_closest_pair(spark, d):
    st = stn.with_country_code(fx.fx_station(spark, d))
    best = pr.closest_pair(st, PAIR_COUNTRY)
    return best.select("ID", "ID_1", r6("distance_km").alias("distance_km"))
