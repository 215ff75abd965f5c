"""Station-archive shaped views derived from the star-schema tables.

The test data has no weather files, so the station, country, state,
inventory and observation tables are derived from customer / nation /
region / orders / events / lineitem / supplier by fixed rules.  Each
view exists twice: as DataFrame code (what the Spark queries use) and as
SQL text (the DuckDB oracle's CTEs).  Both must give identical rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.plans.tables import table

# The four-character element codes that stand for the order priorities
INVENTORY_CODES = {"1-URGENT": "PRCP", "2-HIGH": "SNOW", "3-MEDIUM": "TMIN", "4-NOT SPECIFIED": "TAVG", "5-LOW": "WESD"}


def _station_id(nation_key: str, entity_key: str) -> Column:
    return F.concat(
        F.lpad(F.col(nation_key).cast("string"), 2, "0"),
        F.lpad(F.col(entity_key).cast("string"), 9, "0"),
    )


def _latitude(key: Column) -> Column:
    return ((key * 7919) % 18000).cast("double") / 100 - 90


def _longitude(key: Column) -> Column:
    return ((key * 104729) % 36000).cast("double") / 100 - 180


def fx_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("CODE"),
        F.concat("n_name", F.lit(" ["), "r_name", F.lit("]")).alias("COUNTRY_NAME"),
    )


def fx_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    seg = c.select(F.substring("c_mktsegment", 1, 2).alias("CODE"), F.col("c_mktsegment").alias("STATE_NAME")).distinct()
    # the one state code no station uses (keeps the dimension-preserving
    # count honest: it must come out with a null count)
    extra = spark.range(1).select(F.lit("PI").alias("CODE"), F.lit("PACIFIC ISLANDS").alias("STATE_NAME"))
    return seg.unionByName(extra)


def fx_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        _station_id("c_nationkey", "c_custkey").alias("ID"),
        _latitude(k),
        _longitude(k),
        F.floor(F.col("c_acctbal") / 10).cast("double"),
        F.when(k % 3 == 0, F.lit("")).otherwise(F.substring("c_mktsegment", 1, 2)).alias("STATE"),
        F.col("c_name").alias("NAME"),
        F.when(k % 5 == 0, F.lit("GSN")).otherwise(F.lit("")).alias("GFLAG"),
        F.when(k % 7 == 0, F.lit("HCN")).when(k % 7 == 1, F.lit("CRN")).otherwise(F.lit("")).alias("HCFLAG"),
        F.when(k % 4 == 0, F.lpad(k.cast("string"), 5, "0")).otherwise(F.lit("")).alias("WMOID"),
    ).toDF("ID", "LATITUDE", "LONGITUDE", "ELEVATION", "STATE", "NAME", "GFLAG", "HCFLAG", "WMOID")


def fx_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    element = F.coalesce(*[F.when(F.col("o_orderpriority") == p, e) for p, e in INVENTORY_CODES.items()])
    return j.groupBy("c_nationkey", "c_custkey", "o_orderpriority").agg(
        F.min(F.year("o_orderdate")).cast("int").alias("FIRSTYEAR"),
        F.max(F.year("o_orderdate")).cast("int").alias("LASTYEAR"),
    ).select(
        _station_id("c_nationkey", "c_custkey").alias("ID"),
        F.round(_latitude(F.col("c_custkey")), 2).alias("LAT"),
        F.round(_longitude(F.col("c_custkey")), 2).alias("LONG"),
        element.alias("ELEMENT"),
        "FIRSTYEAR",
        "LASTYEAR",
    )


def fx_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx_obs_time(spark, sf_dir).select("ID", "DATE", "ELEMENT", "VALUE")


def fx_obs_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_obs plus the three flags (null where blank) and the time of day as ``HHmm`` text."""
    e = table(spark, sf_dir, "events")
    c = table(spark, sf_dir, "customer")
    et, k = F.col("event_type"), F.col("event_id")
    element = (
        F.when(et == "view", "TMIN")
        .when(et == "click", "TMAX")
        .when(et == "purchase", "PRCP")
        .when(et == "signup", "SNOW")
        .otherwise("TAVG")
    )
    return e.join(c, e.user_id == c.c_custkey).select(
        _station_id("c_nationkey", "c_custkey").alias("ID"),
        F.col("ts").cast("date").alias("DATE"),
        element.alias("ELEMENT"),
        F.col("value").alias("VALUE"),
        F.when(k % 4 == 0, "H").when(k % 4 == 1, "P").alias("MFLAG"),
        F.when(k % 9 == 0, "G").alias("QFLAG"),
        F.when(k % 3 == 0, "S").when(k % 3 == 1, "7").otherwise("W").alias("SFLAG"),
        F.date_format("ts", "HHmm").alias("OBV_TIME"),
    )


def fx_obs_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier")
    rf = F.col("l_returnflag")
    return li.join(s, li.l_suppkey == s.s_suppkey).select(
        _station_id("s_nationkey", "s_suppkey").alias("ID"),
        F.col("l_shipdate").cast("date").alias("DATE"),
        F.when(rf == "R", "PRCP").when(rf == "A", "TMIN").otherwise("TMAX").alias("ELEMENT"),
        F.col("l_quantity").alias("VALUE"),
    )


# --- the same views as SQL (DuckDB oracle CTEs) ---
FIXTURE_SQL = {
    "fx_country": """SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS CODE,
       concat(n_name, ' [', r_name, ']') AS COUNTRY_NAME
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "fx_state": """SELECT DISTINCT substr(c_mktsegment, 1, 2) AS CODE, c_mktsegment AS STATE_NAME FROM customer
UNION ALL SELECT 'PI' AS CODE, 'PACIFIC ISLANDS' AS STATE_NAME""",
    "fx_station": """SELECT concat(lpad(CAST(c_nationkey AS VARCHAR), 2, '0'), lpad(CAST(c_custkey AS VARCHAR), 9, '0')) AS ID,
  CAST((c_custkey * 7919) % 18000 AS DOUBLE) / 100 - 90 AS LATITUDE,
  CAST((c_custkey * 104729) % 36000 AS DOUBLE) / 100 - 180 AS LONGITUDE,
  CAST(floor(c_acctbal / 10) AS DOUBLE) AS ELEVATION,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE substr(c_mktsegment, 1, 2) END AS STATE,
  c_name AS NAME,
  CASE WHEN c_custkey % 5 = 0 THEN 'GSN' ELSE '' END AS GFLAG,
  CASE c_custkey % 7 WHEN 0 THEN 'HCN' WHEN 1 THEN 'CRN' ELSE '' END AS HCFLAG,
  CASE WHEN c_custkey % 4 = 0 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0') ELSE '' END AS WMOID
FROM customer""",
    "fx_inventory": """SELECT concat(lpad(CAST(c_nationkey AS VARCHAR), 2, '0'), lpad(CAST(c_custkey AS VARCHAR), 9, '0')) AS ID,
  round(CAST((c_custkey * 7919) % 18000 AS DOUBLE) / 100 - 90, 2) AS LAT,
  round(CAST((c_custkey * 104729) % 36000 AS DOUBLE) / 100 - 180, 2) AS LONG,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'PRCP' WHEN '2-HIGH' THEN 'SNOW' WHEN '3-MEDIUM' THEN 'TMIN'
    WHEN '4-NOT SPECIFIED' THEN 'TAVG' WHEN '5-LOW' THEN 'WESD' END AS ELEMENT,
  CAST(min(year(o_orderdate)) AS INTEGER) AS FIRSTYEAR, CAST(max(year(o_orderdate)) AS INTEGER) AS LASTYEAR
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY c_nationkey, c_custkey, o_orderpriority""",
    "fx_obs": """SELECT concat(lpad(CAST(c_nationkey AS VARCHAR), 2, '0'), lpad(CAST(c_custkey AS VARCHAR), 9, '0')) AS ID,
  CAST(ts AS DATE) AS DATE,
  CASE event_type WHEN 'view' THEN 'TMIN' WHEN 'click' THEN 'TMAX' WHEN 'purchase' THEN 'PRCP' WHEN 'signup' THEN 'SNOW' ELSE 'TAVG' END AS ELEMENT,
  value AS VALUE
FROM events JOIN customer ON user_id = c_custkey""",
    "fx_obs_time": """SELECT concat(lpad(CAST(c_nationkey AS VARCHAR), 2, '0'), lpad(CAST(c_custkey AS VARCHAR), 9, '0')) AS ID,
  CAST(ts AS DATE) AS DATE,
  CASE event_type WHEN 'view' THEN 'TMIN' WHEN 'click' THEN 'TMAX' WHEN 'purchase' THEN 'PRCP' WHEN 'signup' THEN 'SNOW' ELSE 'TAVG' END AS ELEMENT,
  value AS VALUE,
  CASE event_id % 4 WHEN 0 THEN 'H' WHEN 1 THEN 'P' END AS MFLAG, CASE event_id % 9 WHEN 0 THEN 'G' END AS QFLAG,
  CASE event_id % 3 WHEN 0 THEN 'S' WHEN 1 THEN '7' ELSE 'W' END AS SFLAG,
  CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS OBS_MINUTE
FROM events JOIN customer ON user_id = c_custkey""",
    "fx_obs_l": """SELECT concat(lpad(CAST(s_nationkey AS VARCHAR), 2, '0'), lpad(CAST(s_suppkey AS VARCHAR), 9, '0')) AS ID,
  CAST(l_shipdate AS DATE) AS DATE,
  CASE l_returnflag WHEN 'R' THEN 'PRCP' WHEN 'A' THEN 'TMIN' ELSE 'TMAX' END AS ELEMENT,
  l_quantity AS VALUE
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
}

FIXTURE_ORDER = ("fx_country", "fx_state", "fx_station", "fx_inventory", "fx_obs_time", "fx_obs_l", "fx_obs")


def with_fixtures(sql: str) -> str:
    """Prefix ``sql`` (which must start with SELECT or WITH-less text) with the
    CTEs of the fixture views it mentions."""
    used = [n for n in FIXTURE_ORDER if re.search(rf"\b{n}\b", sql)]
    if not used:
        return sql
    ctes = ",\n".join(f"{n} AS (\n{FIXTURE_SQL[n]}\n)" for n in used)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
