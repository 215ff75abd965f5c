"""The designs behind the lake questions: buckets, rollup, bitmaps, bit masks, quarantine."""

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from stratus.operators import bitmaps as bm
from stratus.operators import element_sets as es
from stratus.operators import observations as ob
from stratus.operators import stations as stn
from stratus.plans import fixtures as fx
from stratus.plans import mechanisms as me
from stratus.sources import buckets as bk
from stratus.sources.daily import read_daily_checked, split_daily
from stratus.sources.lake import read_observation_lake
from stratus.streaming import rollup as ru
from stratus.streaming.ingest import batch_name, ingest_batch
from tests.test_plans import final_plan

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


# ------------------------------------------------------------- buckets
@pytest.mark.parametrize("key", ["bucketed_tmin_without_tmax", "bucketed_except_tmin_tmax", "bucketed_daily_series"])
def test_bucketed_questions_shuffle_nothing(spark, key):
    plan = final_plan(E.queries()[key](spark, SF))
    assert "Exchange" not in plan and "Bucketed: true" in plan


def test_buckets_hold_one_file_each_and_open_in_another_catalog(spark):
    path = tempfile.mkdtemp(prefix="stratus-buckets-") + "/t"
    bk.write_buckets(fx.fx_obs(spark, SF), "t_first", path, 4)
    assert len(glob.glob(f"{path}/part-*")) == 4
    again = bk.open_buckets(spark, "t_other", path, 4)
    missing = ob.station_days_missing(again)
    assert rows_of(missing) == rows_of(ob.station_days_missing(fx.fx_obs(spark, SF)))
    assert "Exchange" not in final_plan(missing)


def test_a_station_with_a_third_of_all_rows_spreads_over_day_buckets(spark):
    day = F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 3000).cast("int"))
    station = F.when(F.col("id") % 3 == 0, "AB000000001").otherwise(F.concat(F.lit("CD"), F.lpad((F.col("id") % 500).cast("string"), 9, "0")))
    obs = spark.range(30_000).select(station.alias("ID"), day.alias("DATE"), F.lit("TMIN").alias("ELEMENT"), F.lit(1.0).alias("VALUE"))
    path = tempfile.mkdtemp(prefix="stratus-buckets-") + "/t"
    t = bk.write_buckets(obs, "t_hot", path, 8, bk.STATION_DAY)
    sizes = [r["count"] for r in t.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 30_000 / 8 * 1.3
    assert "Exchange" not in final_plan(bk.station_days(t))
    assert bk.buckets_for(10 * 2**30, 2**30) == 10 and bk.buckets_for(0) == 1


def test_except_treats_nulls_as_subtract_does(spark):
    rows = [(None, "TMIN"), (None, "TMIN"), ("A", "TMIN"), ("A", "TMAX"), ("B", "TMIN"), ("B", "TMIN"), (None, "TMAX")]
    obs = spark.createDataFrame(rows, "ID string, ELEMENT string").withColumn("DATE", F.lit("2000-01-01").cast("date"))
    assert rows_of(bk.station_days(obs)) == rows_of(ob.station_days_except(obs))


# -------------------------------------------------------------- rollup
def _daily(spark, seed, n):
    return spark.range(n).select(
        F.concat(F.element_at(F.array(F.lit("AB"), F.lit("CD"), F.lit("EF")), (F.xxhash64("id", F.lit(seed)) % 3 + 3).cast("int") % 3 + 1), F.lit("000000001")).alias("ID"),
        F.date_add(F.lit("1999-06-01").cast("date"), (F.col("id") % 900).cast("int")).alias("DATE"),
        F.when(F.col("id") % 4 == 0, "TMAX").otherwise("PRCP").alias("ELEMENT"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 97).cast("float")).alias("VALUE"),
        F.lit("0700").alias("OBV_TIME"),
    )


def test_rollup_equals_recomputation_after_repeated_deliveries(spark):
    base = tempfile.mkdtemp(prefix="stratus-rollup-")
    lake, roll = f"{base}/lake", f"{base}/rollup"
    parts = [_daily(spark, s, 400 + 100 * s) for s in range(3)]
    for i in (0, 1, 1, 2, 0):  # deliveries that come again change nothing
        ingest_batch(parts[i], lake, batch_name("ckpt", i), roll)
    everything = parts[0].unionByName(parts[1]).unionByName(parts[2])
    want = rows_of(ob.country_year_average(everything))
    for source in (read_observation_lake(spark, lake), None):
        got = ob.country_year_average(source) if source else ru.average_by_country_year(ru.read_states(spark, roll))
        assert [r[:2] for r in rows_of(got)] == [r[:2] for r in want]
        assert [r[2] for r in rows_of(got)] == pytest.approx([r[2] for r in want])
    assert rows_of(ru.rows_per_year(ru.read_states(spark, roll))) == rows_of(ob.observations_per_year(everything))
    # a delivery that comes again with other rows replaces the ones it left
    ingest_batch(parts[0].limit(0), lake, batch_name("ckpt", 2), roll)
    left = ru.rows_per_year(ru.read_states(spark, roll)).agg(F.sum("observation_count")).first()[0]
    assert left == 400 + 500


def test_compaction_keeps_the_answers_and_refuses_merged_deliveries(spark):
    base = tempfile.mkdtemp(prefix="stratus-rollup-")
    for i in range(3):
        assert ru.add_delivery(_daily(spark, i, 300), f"{base}/r", f"d{i}")
    merged = ru.compact_states(spark, f"{base}/r", f"{base}/r2")
    assert rows_of(ru.rows_per_year(ru.read_states(spark, merged))) == rows_of(ru.rows_per_year(ru.read_states(spark, f"{base}/r")))
    assert not ru.add_delivery(_daily(spark, 1, 300), merged, "d1")
    assert ru.add_delivery(_daily(spark, 3, 50), merged, "d3")
    third = ru.compact_states(spark, merged, f"{base}/r3")
    assert not ru.add_delivery(_daily(spark, 0, 300), third, "d0") and not ru.add_delivery(_daily(spark, 3, 50), third, "d3")
    assert ru.read_states(spark, third).agg(F.sum("n_rows")).first()[0] == 950


# ------------------------------------------------------------- bitmaps
def test_numbers_are_dense_and_stable(spark):
    ids = spark.range(5000).select(F.concat(F.lit("S"), F.col("id") % 1700).alias("ID"))
    ids = ids.unionByName(spark.createDataFrame([(None,)], "ID string"))
    first, second = (rows_of(bm.number_keys(x, "ID")) for x in (ids, ids.repartition(7)))
    assert first == second and sorted(n for _, n in first) == list(range(1, 1701))


def test_bitmaps_count_exactly_and_shuffle_a_row_per_bucket(spark):
    """Groups beyond one bucket (32,768 numbers), a hot group with a third of the rows, repeated and null numbers."""
    rows = spark.range(300_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5).alias("g"), F.when(F.col("id") % 17 != 0, F.col("id") % 70_001 + 1).alias("NUMBER")
    )
    maps = bm.key_bitmaps(rows, by=["g"])
    want = rows_of(rows.groupBy("g").agg(F.count_distinct("NUMBER")))
    assert rows_of(bm.bitmap_counts(maps, ["g"])) == want
    assert maps.count() == 5 * 3  # 70,001 numbers fill three buckets
    everything = bm.bitmap_counts(bm.merge_bitmaps(maps))
    assert everything.first()[0] == rows.agg(F.count_distinct("NUMBER")).first()[0]
    assert bm.bitmap_counts(maps.filter("false")).first()[0] == 0
    # before the shuffle there is a partial aggregate: the bitmaps travel, not the numbers
    plan = final_plan(maps)
    assert plan.index("Exchange") < plan.index("partial_bitmap_construct_agg")


# -------------------------------------------------------- element sets
def test_masks_beyond_64_elements(spark):
    names = [f"E{i:03d}" for i in range(160)]
    inv = spark.range(4000).select(
        F.concat(F.lit("S"), F.col("id") % 40).alias("ID"),
        F.concat(F.lit("E"), F.lpad((F.pmod(F.xxhash64("id"), F.col("id") % 40 * 4 + 1)).cast("string"), 3, "0")).alias("ELEMENT"),
    )
    core = ["E000", "E001", "E063", "E064", "E149"]
    got = es.element_profile(inv, core, "E000", names)
    lists = {r.ID: r.element_list for r in stn.element_list(inv).collect()}
    assert max(map(len, lists.values())) > 64
    for r in got.collect():
        have = set(lists[r.ID])
        assert r.element_list == sorted(have) and r.element_count == len(have)
        assert r.core_count == len(have & set(core)) and r.other_count == len(have - set(core))
        assert r.all_core == (set(core) <= have) and r.only_one == (have == {"E000"})


def test_masks_aggregate_in_hash_tables_only(spark):
    plan = final_plan(E.queries()["station_element_masks"](spark, SF))
    assert "HashAggregate" in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    stations = [l for l in plan.splitlines() if "HashAggregate(keys=[ID]" in l.replace("keys=[ID#", "keys=[ID")]
    assert len(stations) <= 2  # partial and final: one aggregate for all questions


def test_masks_edges(spark):
    inv = spark.createDataFrame([("a", None), ("a", None), ("b", "X"), ("b", None), ("c", "Y"), (None, "X")], "ID string, ELEMENT string")
    got = {r.ID: r for r in es.element_profile(inv, ["X", "never"], "X").collect()}
    assert (got["a"].element_count, got["a"].only_one, got["a"].element_list) == (0, False, [])
    assert got["b"].only_one and not got["b"].all_core and got["b"].core_count == 1 and got[None].element_list == ["X"]
    assert es.element_profile(inv.limit(0), ["X"], "X").collect() == []
    with pytest.raises(Exception, match="outside the vocabulary"):
        es.element_profile(inv, ["X"], "X", ["X"]).collect()
    with pytest.raises(ValueError):
        es.element_vocabulary(inv, most=1)


# ---------------------------------------------------------- quarantine
LINES = {
    "AB000000001,20200131,PRCP,12,,,S,0700": None,
    "AB000000001,20200131,PRCP,,,,S,": None,
    "AB000000001,,PRCP,1.5,,,S,2400": None,
    "AB000000001,20200132,PRCP,1,,,S,0700": ["DATE"],
    "AB000000001,2020-01-31,PRCP,1,,,S,0700": ["DATE"],
    "AB000000001,20200131,PRCP,one,,,S,0700": ["VALUE"],
    "AB000000001,20200131,PRCP,1,,,S,0760": ["OBV_TIME"],
    "AB000000001,20200131,PRCP,1": ["fields"],
    "AB000000001,20200131,PRCP,1,,,S,0700,more": ["fields"],
    "AB000000001,never,PRCP,one,,,S,99": ["DATE", "VALUE", "OBV_TIME"],
}


def test_lines_are_quarantined_with_their_file_and_fields(spark):
    base = tempfile.mkdtemp(prefix="stratus-quarantine-")
    for i, part in enumerate((list(LINES)[:5], list(LINES)[5:])):
        os.makedirs(f"{base}/in", exist_ok=True)
        with open(f"{base}/in/{i}.csv", "w") as f:
            f.write("\n".join(part) + "\n")
    good, bad = split_daily(spark, f"{base}/in", f"{base}/out")
    found = {r.RAW_LINE: r for r in bad.collect()}
    assert {k: list(r.FAILED_FIELDS) for k, r in found.items()} == {k: v for k, v in LINES.items() if v}
    for i, line in enumerate(LINES):
        if LINES[line]:
            assert found[line].SOURCE_FILE.endswith("0.csv" if i < 5 else "1.csv")
    assert sorted(map(str, ((str(r.DATE), r.VALUE, r.OBV_TIME) for r in good.collect()))) == [
        "('2020-01-31', 12.0, '0700')", "('2020-01-31', None, None)", "('None', 1.5, '2400')",
    ]
    empty = f"{base}/none"
    os.makedirs(empty)
    open(f"{empty}/0.csv", "w").close()
    assert [x.count() for x in split_daily(spark, empty, f"{base}/out2")] == [0, 0]


def test_quarantine_reads_the_text_once(spark):
    files = tempfile.mkdtemp(prefix="stratus-quarantine-") + "/f"
    me.defective_lines(fx.fx_obs_time(spark, SF)).write.text(files)
    plan = final_plan(read_daily_checked(spark, files))
    assert plan.count("FileScan text") == 1
