"""Queries on the physical designs behind the questions, registered next to the others.

Bucketed tables, states kept up to date by deliveries, bitmaps, bit masks
and quarantined lines: each answers a question of ``queries`` in another
way, over the same whole tables, and has its own SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.functions.columns import array_text, obs_minute
from stratus.operators import bitmaps as bm
from stratus.operators import element_sets as es
from stratus.operators import observations as ob
from stratus.plans import fixtures as fx
from stratus.plans.queries import (
    INV_CORE, ONLY_ELEMENT, PAIR_COUNTRY, SQL_COUNTRY_TT, SQL_PER_YEAR, SQL_RAINFALL, SQL_TMIN_ONLY, _in, query, r6,
)
from stratus.session import output_path
from stratus.sources import buckets as bk
from stratus.sources.daily import format_daily_csv_columns, read_daily_csv, split_daily, write_daily_archive
from stratus.streaming import rollup as ru
from stratus.streaming.ingest import batch_name, ingest_batch, ingest_daily_stream

BUCKETS = 8


# ============================================================ buckets
def bucketed(spark, obs: DataFrame, by, buckets: int = BUCKETS) -> DataFrame:
    path = output_path(spark, "buckets")
    return bk.write_buckets(obs, path.rsplit("/", 1)[1].replace("-", "_"), path, buckets, by)


@query("bucketed_tmin_without_tmax", SQL_TMIN_ONLY)
def bucketed_tmin_without_tmax(spark, d):
    return ob.station_days_missing(bucketed(spark, fx.fx_obs(spark, d), bk.STATION), "TMIN", "TMAX")


@query(
    "bucketed_except_tmin_tmax",
    "SELECT ID, DATE FROM fx_obs WHERE ELEMENT = 'TMIN' EXCEPT SELECT ID, DATE FROM fx_obs WHERE ELEMENT = 'TMAX'",
)
def bucketed_except_tmin_tmax(spark, d):
    return bk.station_days(bucketed(spark, fx.fx_obs(spark, d), bk.STATION_DAY), "TMIN", "TMAX")


@query(
    "bucketed_daily_series",
    f"""SELECT ID, DATE, ELEMENT, round(avg(VALUE), 6) AS AVERAGE, CAST(year(DATE) AS INTEGER) AS YEAR
{SQL_COUNTRY_TT} GROUP BY ID, DATE, ELEMENT""",
)
def bucketed_daily_series(spark, d):
    obs = bucketed(spark, fx.fx_obs_l(spark, d), bk.STATION)
    s = ob.daily_series_average(ob.country_elements(obs, PAIR_COUNTRY, ("TMIN", "TMAX")))
    return s.select("ID", "DATE", "ELEMENT", r6("AVERAGE").alias("AVERAGE"), "YEAR")


# ============================================================= rollup
def delivered(spark, d) -> str:
    """All of fx_obs_l through the ingest in three deliveries, the second one twice: the rollup's folder."""
    obs = fx.fx_obs_l(spark, d).withColumn("part", F.month("DATE") % 3)
    rollup, lake = output_path(spark, "rollup"), output_path(spark, "rollup-lake")
    for part in (0, 1, 2):
        files, seen = output_path(spark, "delivery"), output_path(spark, "delivery-ckpt")
        write_daily_archive(obs.filter(F.col("part") == part).drop("part"), files, by_year=False)
        ingest_daily_stream(spark, files, lake, seen, rollup_dir=rollup)
        if part == 1:  # what a restart does that finds the batch written, but not committed
            ingest_batch(read_daily_csv(spark, files), lake, batch_name(seen, 0), rollup)
    return rollup


@query("rollup_rainfall_country_year", SQL_RAINFALL)
def rollup_rainfall_country_year(spark, d):
    r = ru.average_by_country_year(ru.read_states(spark, delivered(spark, d)), fx.fx_country(spark, d), "PRCP")
    return r.select("COUNTRY_CODE", "YEAR", r6("AVERAGE").alias("AVERAGE"), "COUNTRY_NAME")


@query("rollup_obs_per_year", SQL_PER_YEAR)
def rollup_obs_per_year(spark, d):
    """From a rollup that has been compacted."""
    into = ru.compact_states(spark, delivered(spark, d), output_path(spark, "rollup-merged"))
    return ru.rows_per_year(ru.read_states(spark, into))


# ============================================================ bitmaps
@query(
    "bitmap_stations_per_year",
    """SELECT substr(ID, 1, 2) AS COUNTRY_CODE, CAST(year(DATE) AS INTEGER) AS YEAR, count(DISTINCT ID) AS station_count
FROM fx_obs_l GROUP BY 1, 2""",
)
def bitmap_stations_per_year(spark, d):
    obs = ob._with_year(ob._with_cc(fx.fx_obs_l(spark, d)))
    numbered = bm.with_numbers(obs, bm.number_keys(obs, "ID"), "ID")
    by = ["COUNTRY_CODE", "YEAR"]
    return bm.bitmap_counts(bm.key_bitmaps(numbered, by=by), by, "station_count")


@query("bitmap_tmin_without_tmax_stations", f"SELECT count(DISTINCT ID) AS station_count FROM ({SQL_TMIN_ONLY}) t")
def bitmap_tmin_without_tmax_stations(spark, d):
    days = ob.station_days_missing(fx.fx_obs(spark, d), "TMIN", "TMAX")
    numbered = bm.with_numbers(days, bm.number_keys(fx.fx_station(spark, d), "ID"), "ID")
    return bm.bitmap_counts(bm.key_bitmaps(numbered), (), "station_count")


# ======================================================== element sets
@query(
    "station_element_masks",
    f"""SELECT ID, count(DISTINCT ELEMENT) AS element_count,
  count(DISTINCT CASE WHEN ELEMENT IN {_in(INV_CORE)} THEN ELEMENT END) AS core_count,
  count(DISTINCT CASE WHEN ELEMENT NOT IN {_in(INV_CORE)} THEN ELEMENT END) AS other_count,
  count(DISTINCT CASE WHEN ELEMENT IN {_in(INV_CORE)} THEN ELEMENT END) = {len(INV_CORE)} AS all_core,
  bool_and(ELEMENT = '{ONLY_ELEMENT}') AS only_one,
  array_to_string(list_sort(list_distinct(list(ELEMENT))), ',') AS element_list FROM fx_inventory GROUP BY ID""",
)
def station_element_masks(spark, d):
    p = es.element_profile(fx.fx_inventory(spark, d), INV_CORE, ONLY_ELEMENT)
    return p.withColumn("element_list", array_text("element_list"))


# ========================================================== quarantine
def defective_lines(obs: DataFrame) -> DataFrame:
    """The archive's lines for ``obs``, with whole numbers as values; some days of every month are written wrongly."""
    text = format_daily_csv_columns(obs.withColumn("VALUE", F.floor("VALUE").cast("long")))
    day, of = F.substring("DATE", 7, 2), F.substring("DATE", 1, 4)
    text = text.withColumns(
        {
            "VALUE": F.when(day == "13", F.lit("n/a")).otherwise(F.col("VALUE")),
            "OBV_TIME": F.when(day == "14", F.concat(F.lit("99"), F.substring("OBV_TIME", 3, 2))).otherwise(F.col("OBV_TIME")),
            "DATE": F.when(day == "15", F.concat(of, F.lit("1399"))).otherwise(F.col("DATE")),
            "cut": F.when(day == "16", 7).otherwise(8),
        }
    )
    fields = F.array(*[F.coalesce(F.col(c), F.lit("")) for c in ("ID", "DATE", "ELEMENT", "VALUE", "MFLAG", "QFLAG", "SFLAG", "OBV_TIME")])
    return text.select(F.array_join(F.slice(fields, F.lit(1), F.col("cut")), ",").alias("value"))


def _lines_sql(d, v, t, n) -> str:
    rest = "coalesce(MFLAG, ''), coalesce(QFLAG, ''), SFLAG"
    return f"SELECT concat_ws(',', ID, {d}, ELEMENT, {v}, {rest}{t}) AS RAW_LINE, '{n}' AS FAILED_FIELDS FROM o"


_YMD, _VAL = "strftime(DATE, '%Y%m%d')", "CAST(CAST(floor(VALUE) AS BIGINT) AS VARCHAR)"
_HHMM = ", lpad(CAST(OBS_MINUTE // 60 AS VARCHAR), 2, '0') || lpad(CAST(OBS_MINUTE % 60 AS VARCHAR), 2, '0')"


@query(
    "src_daily_quarantine",
    f"""WITH o AS (SELECT *, day(DATE) AS d FROM fx_obs_time)
{_lines_sql(_YMD, "'n/a'", _HHMM, 'VALUE')} WHERE d = 13
UNION ALL {_lines_sql(_YMD, _VAL, ", '99' || lpad(CAST(OBS_MINUTE % 60 AS VARCHAR), 2, '0')", 'OBV_TIME')} WHERE d = 14
UNION ALL {_lines_sql("year(DATE) || '1399'", _VAL, _HHMM, 'DATE')} WHERE d = 15
UNION ALL {_lines_sql(_YMD, _VAL, '', 'fields')} WHERE d = 16""",
)
def src_daily_quarantine(spark, d):
    files = output_path(spark, "defective")
    defective_lines(fx.fx_obs_time(spark, d)).write.option("compression", "gzip").text(files)
    _, bad = split_daily(spark, files, output_path(spark, "split"))
    return bad.select("RAW_LINE", array_text("FAILED_FIELDS").alias("FAILED_FIELDS"))


@query(
    "src_daily_good_lines",
    """SELECT ELEMENT, OBS_MINUTE, count(*) AS observation_count, CAST(sum(floor(VALUE)) AS BIGINT) AS total
FROM fx_obs_time WHERE day(DATE) NOT BETWEEN 13 AND 16 GROUP BY 1, 2""",
)
def src_daily_good_lines(spark, d):
    files = output_path(spark, "defective")
    defective_lines(fx.fx_obs_time(spark, d)).write.option("compression", "gzip").text(files)
    good, _ = split_daily(spark, files, output_path(spark, "split"))
    by = good.groupBy("ELEMENT", obs_minute("OBV_TIME").alias("OBS_MINUTE"))
    return by.agg(F.count(F.lit(1)).alias("observation_count"), F.sum("VALUE").cast("long").alias("total"))
