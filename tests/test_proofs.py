"""Content checks, order proofs, listings, zone maps, samples and shared subplans."""

import datetime as dt
import glob
import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from stratus.operators import preview as pv
from stratus.operators import sampling as sa
from stratus.plans import fixtures as fx
from stratus.plans import proofs as pf
from stratus.sources import fingerprint as fp
from stratus.sources import zones as zo
from stratus.sources.listing import folder_totals, list_folder
from stratus.sources.order_proof import disorders, file_parts, order_proof
from stratus.sources.sinks import write_sorted
from tests.test_plans import final_plan

SF = "/root/testdata/sf0.001"


def folder():
    return tempfile.mkdtemp(prefix="stratus-proofs-")


# -------------------------------------------------------- fingerprints
def test_one_changed_value_is_found(spark):
    rows = fx.fx_obs_time(spark, SF)
    path = folder() + "/csv"
    seen = fp.write_fingerprinted(rows.repartition(3), path)
    ok = fp.reconcile_content(spark, path, rows.schema, seen).first()
    assert ok.same_rows and ok.same_content and ok.data_rows == rows.count()
    part = sorted(glob.glob(f"{path}/part-*"))[1]
    with open(part) as f:
        lines = f.readlines()
    lines[2] = lines[2].replace(lines[2].split(",")[0], "99000000000", 1)
    for crc in glob.glob(f"{path}/.*.crc"):
        os.remove(crc)
    with open(part, "w") as f:
        f.writelines(lines)
    bad = fp.reconcile_content(spark, path, rows.schema, seen).first()
    assert bad.same_rows and not bad.same_content


def test_fingerprints_depend_on_rows_not_on_their_order(spark):
    schema = "a string, b string, c double"
    one = [("x", None, 1.0), (None, "x", 1.0), ("x", "", 2.5), ("x", "", 2.5)]
    mark = lambda rows: tuple(fp.fingerprint(spark.createDataFrame(rows, schema)).first())
    assert mark(one) == mark(one[::-1]) and tuple(fp.fingerprint(spark.createDataFrame(one, schema).select("c", "b", "a")).first()) == mark(one)
    for other in ([*one[:2], one[2]], [("x", "x", 1.0), (None, None, 1.0), *one[2:]], [one[0], one[0], *one[2:]], [*one[:3], ("x", None, 2.5)]):
        assert mark(other) != mark(one)
    assert mark([]) == (0, 0, 0)


def test_written_rows_are_computed_once(spark):
    count = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        count.add(1)
        return x

    rows = spark.range(50).select(counted(F.col("id").cast("string")).alias("x"))
    fp.write_fingerprinted(rows, folder() + "/csv")
    assert count.value == 50


# --------------------------------------------------------------- order
def sorted_files(spark, path=None):
    path = path or folder() + "/sorted"
    return write_sorted(fx.fx_obs(spark, SF).repartition(6), path, ["ID", "DATE", "ELEMENT"])


def read_sorted(spark, path):
    return spark.read.option("header", "true").schema("ID string, DATE date, ELEMENT string, VALUE double").csv(path)


def test_a_swapped_part_file_is_found(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep eight part files
    try:
        path = sorted_files(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    keys = ["ID", "DATE", "ELEMENT"]
    proof = order_proof(read_sorted(spark, path), keys)
    assert proof.first().in_order and proof.first().data_rows == fx.fx_obs(spark, SF).count()
    plan = final_plan(file_parts(read_sorted(spark, path), keys))
    assert "Exchange" not in plan and "Sort" not in plan
    parts = sorted(glob.glob(f"{path}/part-*"))
    assert len(parts) > 3
    other = folder() + "/swapped"
    os.makedirs(other)
    for i, p in enumerate(parts):  # the second and the third file change places
        shutil.copy(p, f"{other}/part-{ {1: 2, 2: 1}.get(i, i):05d}.csv")
    assert not order_proof(read_sorted(spark, other), keys).first().in_order
    found = disorders(file_parts(read_sorted(spark, other), keys)).collect()
    assert {r.file for r in found} <= {f"part-{i:05d}.csv" for i in (1, 2, 3)} and all(r.ascending for r in found)


def test_a_line_out_of_place_is_found_across_batches(spark):
    path = folder()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for name, rows in (("a", [1, 2, 2, 3] * 1), ("b", list(range(3, 40)))):
            with open(f"{path}/{name}.csv", "w") as f:
                f.write("".join(f"{x},t\n" for x in rows))
        read = lambda: spark.read.schema("n int, t string").csv(path)
        assert tuple(order_proof(read(), ["n"]).first()) == (41, True)
        with open(f"{path}/b.csv", "a") as f:
            f.write("38,t\n")
        assert tuple(order_proof(read(), ["n"]).first()) == (42, False)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def test_nulls_come_first_and_nothing_is_in_order(spark):
    path = folder() + "/p"
    spark.createDataFrame([(None, "b"), (1, None), (1, "a")], "n int, t string").coalesce(1).write.parquet(path)
    assert tuple(order_proof(spark.read.parquet(path), ["n", "t"]).first()) == (3, True)
    assert tuple(order_proof(spark.read.parquet(path), ["t"]).first()) == (3, False)
    empty = folder()
    open(f"{empty}/none.csv", "w").close()
    assert tuple(order_proof(spark.read.schema("n int").csv(empty), ["n"]).first()) == (0, True)


# ------------------------------------------------------------- listing
def test_listing_has_directories_hidden_and_empty_files(spark):
    root = folder()
    for name, text in (("a/x.csv", "12345"), ("a/empty.csv", ""), ("a/deep/er/y.csv", "12"), ("_log", "1"), ("b/.part.crc", "123"), ("top.txt", "1234")):
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "w") as f:
            f.write(text)
    os.makedirs(f"{root}/nothing")
    want = {
        "a": ("directory", 0, False), "a/x.csv": ("file", 5, False), "a/empty.csv": ("file", 0, False), "a/deep": ("directory", 0, False),
        "a/deep/er": ("directory", 0, False), "a/deep/er/y.csv": ("file", 2, False), "_log": ("file", 1, True), "b": ("directory", 0, False),
        "b/.part.crc": ("file", 3, True), "top.txt": ("file", 4, False), "nothing": ("directory", 0, False),
    }
    for wanted in (1, 3, 32):
        listing = list_folder(spark, root, wanted)
        assert {r.path: (r.kind, r.bytes, r.hidden) for r in listing.collect()} == want and listing.count() == len(want)
        assert listing.rdd.getNumPartitions() >= min(wanted, 4)
    totals = {r.folder: (r.files, r.empty_files, r.bytes) for r in folder_totals(list_folder(spark, root)).collect()}
    assert totals == {"": (6, 1, 15), "a": (3, 1, 7), "a/deep": (1, 0, 2), "a/deep/er": (1, 0, 2), "b": (1, 0, 3), "nothing": (0, 0, 0)}
    assert list_folder(spark, f"{root}/nothing").count() == 0
    with pytest.raises(Exception, match="path"):
        spark.read.format("folder_listing").load().count()


# --------------------------------------------------------------- zones
def test_zone_map_opens_fewer_files_and_loses_nothing(spark):
    lake = pf.zoned_lake(fx.fx_obs_l(spark, SF), rows_per_file=100)
    zones = zo.build_zones(spark, lake).cache()
    everything = spark.read.parquet(lake)
    assert zones.count() == len(everything.inputFiles()) and zones.agg(F.sum("n_rows")).first()[0] == everything.count()
    days = (dt.date(1998, 3, 1), dt.date(1998, 4, 30))
    codes = sorted(r[0] for r in everything.select("COUNTRY_CODE").distinct().collect())
    for can, rows in (
        (zo.may_hold("COUNTRY_CODE", codes[:1] + codes[-1:]), F.col("COUNTRY_CODE").isin(codes[0], codes[-1])),
        (zo.may_hold("DATE", least=days[0], most=days[1]), F.col("DATE").between(*days)),
        (zo.may_hold("ELEMENT", ["PRCP"]) & zo.may_hold("COUNTRY_CODE", [codes[1]]), (F.col("ELEMENT") == "PRCP") & (F.col("COUNTRY_CODE") == codes[1])),
    ):
        some = zo.read_zones(spark, lake, zones, can)
        assert len(some.inputFiles()) < len(everything.inputFiles()) * 0.8
        want = everything.filter(rows)
        assert want.count() > 0 and some.filter(rows).exceptAll(want).count() == 0 and want.exceptAll(some.filter(rows)).count() == 0
    none = zo.read_zones(spark, lake, zones, zo.may_hold("COUNTRY_CODE", ["zz"]))
    assert none.count() == 0 and none.columns == everything.columns
    zones.unpersist()


# ------------------------------------------------------------- samples
def test_samples_do_not_depend_on_partitions_and_merge(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"), "id")
    take = lambda df: sorted(tuple(r) for r in df.collect())
    want = take(sa.bottom_k(rows, ["g"], "id", 4))
    assert len(want) == 4 * len({g for g, *_ in want})
    assert take(sa.bottom_k(rows.repartition(13), ["g"], "id", 4)) == want
    halves = [sa.bottom_k(rows.filter(F.col("id") % 2 == i), ["g"], "id", 4) for i in (0, 1)]
    assert take(sa.merge_samples(*halves, ["g"], "id", 4).select("g", "id", "DIGEST")) == want
    plan = final_plan(sa.bottom_k(rows, ["g"], "id", 4))
    assert plan.count("WindowGroupLimit") == 2 and plan.rindex("WindowGroupLimit") > plan.index("Exchange")


# ------------------------------------------------- previews, column names
def test_preview_is_what_a_console_shows(spark, capsys):
    rows = [(i, "x" * (i + 16) if i % 4 else None, None if i == 3 else i / 4) for i in range(30, 0, -1)]
    df = spark.createDataFrame(rows, "`a.key` long, `b/text` string, `c``d` double").repartition(5)
    first = pv.preview(df, ["a.key"], 7)
    assert first.columns == df.columns
    df.orderBy("`a.key`").show(7)
    shown = [[c.strip() for c in line.split("|")[1:-1]] for line in capsys.readouterr().out.splitlines() if line.startswith("|")][1:]
    assert [list(r) for r in first.collect()] == shown and len(shown) == 7
    assert "TakeOrderedAndProject" in final_plan(pv.preview(df, ["a.key"], 7))
    assert pv.preview(df.limit(0), ["a.key"]).count() == 0
    assert pv.preview(df, ["a.key"], 1, 2).first()["b/text"] == "xx"


def test_slash_in_a_name_is_found_in_any_case(spark):
    near = E.queries()["proj_slash_name"](spark, SF)
    assert near.columns == ["ID", "ID_1", "Distance/km"]
    rows = [tuple(r) for r in near.collect()]
    assert rows == sorted(rows, key=lambda r: (r[2], r[0], r[1])) and len(rows) == pf.SUBSET_SIZE * (pf.SUBSET_SIZE - 1)
    assert near.filter(F.col("DISTANCE/KM") >= rows[4][2]).count() == len(rows) - 4


@pytest.mark.parametrize("key", ["sink_reconcile_content", "sink_sorted_proof", "src_full_listing"])
def test_queries_have_rows(spark, key):
    assert E.queries()[key](spark, SF).count() > 0
