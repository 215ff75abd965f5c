"""End-to-end job on archive-format files rendered from the test tables."""

import os
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from stratus.layouts import COUNTRY_LAYOUT, INVENTORY_LAYOUT, STATE_LAYOUT, STATION_LAYOUT
from stratus.plans import archive as ar
from stratus.plans import fixtures as fx
from stratus.plans.queries import INV_CORE, ONLY_ELEMENT
from stratus.sources.daily import read_daily_csv, write_daily_archive
from stratus.sources.fixed_width import render_fixed_width
from stratus.sources.lake import read_observation_lake, write_observation_lake
from stratus.streaming.ingest import ingest_daily_stream

SF = "/root/testdata/sf0.01"


def _write_text(df, path):
    df.coalesce(1).write.mode("overwrite").text(path)
    return path


def test_archive_job_end_to_end(spark):
    base = tempfile.mkdtemp(prefix="stratus-archive-")
    st = fx.fx_station(spark, SF).withColumn("LATITUDE", F.round("LATITUDE", 4)).withColumn("LONGITUDE", F.round("LONGITUDE", 4))
    paths = dict(
        stations=_write_text(render_fixed_width(st, STATION_LAYOUT), f"{base}/stations"),
        countries=_write_text(render_fixed_width(fx.fx_country(spark, SF), COUNTRY_LAYOUT), f"{base}/countries"),
        states=_write_text(render_fixed_width(fx.fx_state(spark, SF), STATE_LAYOUT), f"{base}/states"),
        inventory=_write_text(render_fixed_width(fx.fx_inventory(spark, SF), INVENTORY_LAYOUT), f"{base}/inventory"),
        daily=write_daily_archive(fx.fx_obs_l(spark, SF), f"{base}/daily", by_year=False),
    )
    a = ar.load_archive(spark, lake=f"{base}/lake", convert=True, check_daily=True, **paths)
    ckpt = spark.sparkContext.getCheckpointDir()
    before = sum(len(f) for _, _, f in os.walk(ckpt.removeprefix("file:"))) if ckpt else 0
    res = ar.analysis(a, "07", 2001, core=INV_CORE, only_element=ONLY_ELEMENT)
    after = spark.sparkContext.getCheckpointDir()
    # declaring the questions runs nothing and leaves no file
    assert after == ckpt and (not ckpt or sum(len(f) for _, _, f in os.walk(ckpt.removeprefix("file:"))) == before)
    assert res["enriched_stations"].count() == 1500
    assert {r.file: (r.lines, r.rejected_values) for r in res["parse_rejects"].collect()} == {
        "stations": (1500, 0), "inventory": (6470, 0), "daily": (60000, 0)}
    assert res["all_core_stations"].count() == 975
    assert res["only_element_stations"].count() == 1
    assert res["multi_network_stations"].count() == 86
    assert res["country_pairs"].count() == 73 * 72 // 2
    assert res["years_covered"].first().year_count == 7
    assert res["country_series"].count() == 2337
    s = res["station_summary"].first()
    assert (s.total, s.no_wmo, s.gsn, s.hcn, s.crn, s.multi_network, s.northern, s.active) == (1500, 1125, 300, 215, 215, 86, 750, 885)
    # the rainfall table equals the registered query's answer
    want = {(r.COUNTRY_CODE, r.YEAR): r.AVERAGE for r in E.queries()["rainfall_country_year"](spark, SF).collect()}
    got = {(r.COUNTRY_CODE, r.YEAR): r.AVERAGE for r in res["rainfall"].collect()}
    assert set(got) == set(want)
    diff = {k: (got[k], want[k]) for k in got if abs(got[k] - want[k]) > 1e-6}
    assert not diff, list(diff.items())[:5]
    # every daily observation's station is a supplier id, not a station: all are "missing"
    assert res["observed_missing_stations"].count() > 0
    out, rows = ar.write_outputs(res, f"{base}/out")
    assert len([f for f in os.listdir(out["rainfall"]) if f.startswith("part-")]) == 1
    written_pairs = spark.read.option("header", "true").csv(out["country_pairs"])
    assert written_pairs.count() == 2628
    assert written_pairs.columns == ["COUNTRY_CODE", "ID", "NAME", "LAT", "LON", "ID_1", "NAME_1", "LAT_1", "LON_1", "distance_km"]
    rec = {r.output: r for r in ar.reconcile_outputs(spark, out, rows).collect()}
    assert set(rec) == set(out) and all(r.ok for r in rec.values())
    assert rec["rainfall"].files == 1 and rows["rainfall"] == 175 and rec["country_pairs"].data_rows == 2628


def test_archive_cli(spark, capsys):
    base = tempfile.mkdtemp(prefix="stratus-cli-")
    sf = "/root/testdata/sf0.001"
    args = [
        "--stations", _write_text(render_fixed_width(fx.fx_station(spark, sf).withColumn("LATITUDE", F.round("LATITUDE", 4)).withColumn("LONGITUDE", F.round("LONGITUDE", 4)), STATION_LAYOUT), f"{base}/stations"),
        "--countries", _write_text(render_fixed_width(fx.fx_country(spark, sf), COUNTRY_LAYOUT), f"{base}/countries"),
        "--states", _write_text(render_fixed_width(fx.fx_state(spark, sf), STATE_LAYOUT), f"{base}/states"),
        "--inventory", _write_text(render_fixed_width(fx.fx_inventory(spark, sf), INVENTORY_LAYOUT), f"{base}/inventory"),
        "--daily", write_daily_archive(fx.fx_obs_l(spark, sf), f"{base}/daily", by_year=False),
        "--out", f"{base}/out", "--lake", f"{base}/lake", "--convert", "--reconcile",
        "--country", "03", "--active-year", "2001",
    ]
    ar.main(args)
    text = capsys.readouterr().out
    assert "total_stations" in text and "year_count" in text and "ok" in text
    assert sorted(os.listdir(f"{base}/out")) == sorted(
        ["enriched-stations.csv.gz", "stations-per-country.csv", "stations-per-state.csv", "country-pair-distances.csv",
         "country-tmin-tmax.csv", "country-series.csv", "rainfall.csv"]
    )


def test_archive_job_on_a_streamed_lake(spark):
    """Batch and stream lakes have one schema: the whole job runs on a streamed one."""
    base = tempfile.mkdtemp(prefix="stratus-streamed-")
    sf = "/root/testdata/sf0.001"
    daily = write_daily_archive(fx.fx_obs_time(spark, sf), f"{base}/daily", by_year=False)
    ingest_daily_stream(spark, daily, f"{base}/lake", f"{base}/ckpt")
    write_observation_lake(read_daily_csv(spark, daily), f"{base}/batch")
    streamed, batch = (read_observation_lake(spark, f"{base}/{x}") for x in ("lake", "batch"))
    assert streamed.dtypes == batch.dtypes
    assert streamed.exceptAll(batch).count() == 0 == batch.exceptAll(streamed).count()
    paths = dict(
        stations=_write_text(render_fixed_width(fx.fx_station(spark, sf), STATION_LAYOUT), f"{base}/stations"),
        countries=_write_text(render_fixed_width(fx.fx_country(spark, sf), COUNTRY_LAYOUT), f"{base}/countries"),
        states=_write_text(render_fixed_width(fx.fx_state(spark, sf), STATE_LAYOUT), f"{base}/states"),
        inventory=_write_text(render_fixed_width(fx.fx_inventory(spark, sf), INVENTORY_LAYOUT), f"{base}/inventory"),
    )
    a = ar.load_archive(spark, daily=daily, lake=f"{base}/lake", **paths)
    pair = streamed.filter(F.col("ELEMENT").isin("TMIN", "TMAX"))
    country = pair.agg(F.max("COUNTRY_CODE")).first()[0]
    out, rows = ar.write_outputs(ar.analysis(a, country, 2001, core=INV_CORE), f"{base}/out")
    assert all(r.ok for r in ar.reconcile_outputs(spark, out, rows).collect()) and rows["country_tmin_tmax"] > 0


def test_shared_metadata_is_read_once_and_released(spark):
    """Inside the scope the files may be gone: every question works on the tables that were read first."""
    base = tempfile.mkdtemp(prefix="stratus-shared-")
    paths = dict(
        stations=_write_text(render_fixed_width(fx.fx_station(spark, SF), STATION_LAYOUT), f"{base}/stations"),
        countries=_write_text(render_fixed_width(fx.fx_country(spark, SF), COUNTRY_LAYOUT), f"{base}/countries"),
        states=_write_text(render_fixed_width(fx.fx_state(spark, SF), STATE_LAYOUT), f"{base}/states"),
        inventory=_write_text(render_fixed_width(fx.fx_inventory(spark, SF), INVENTORY_LAYOUT), f"{base}/inventory"),
        daily=write_daily_archive(fx.fx_obs_l(spark, SF), f"{base}/daily", by_year=False),
    )
    a = ar.load_archive(spark, check_daily=False, **paths)
    want = ar.analysis(a, "07", 2001, core=INV_CORE)["enriched_stations"].collect()
    kept = len(spark.sparkContext._jsc.getPersistentRDDs())
    with ar.shared_metadata(a) as held:
        res = ar.analysis(held, "07", 2001, core=INV_CORE)
        for name in ("stations", "countries", "states", "inventory"):
            getattr(held, name).count()
            for f in os.listdir(paths[name]):
                if f.startswith("part-"):
                    with open(f"{paths[name]}/{f}", "w") as out:
                        out.write("changed behind our back")
        assert sorted(map(str, res["enriched_stations"].collect())) == sorted(map(str, want))
        plan = res["enriched_stations"]._jdf.queryExecution().executedPlan().toString()
        assert plan.count("InMemoryTableScan") >= 4
        ar.write_outputs(res, f"{base}/out")
        assert len(spark.sparkContext._jsc.getPersistentRDDs()) == kept + 4
        assert res["stations_per_state"].agg(F.sum("STATION_NUM_STATE")).first()[0] > 0
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == kept
