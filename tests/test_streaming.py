"""Streaming ingest into the lake: exactly once across re-runs and new files."""

import os
import tempfile

from pyspark.sql import functions as F

from stratus.sources.daily import write_daily_archive
from stratus.sources.lake import read_observation_lake, write_observation_lake
from stratus.streaming.ingest import ingest_daily_stream


def _obs(spark, year, n):
    return spark.range(n).select(
        F.concat(F.lit("AB"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("ID"),
        F.make_date(F.lit(year), F.lit(1), (F.col("id") % 28 + 1).cast("int")).alias("DATE"),
        F.lit("PRCP").alias("ELEMENT"),
        F.col("id").cast("float").alias("VALUE"),
    )


def test_ingest_is_exactly_once(spark):
    base = tempfile.mkdtemp(prefix="stratus-stream-")
    src, lake, ckpt = (os.path.join(base, x) for x in ("src", "lake", "ckpt"))
    write_daily_archive(_obs(spark, 2020, 500), os.path.join(src, "a"), by_year=False)
    # the source folder is read recursively only at its top level: move part files up
    for f in os.listdir(os.path.join(src, "a")):
        if f.startswith("part-"):
            os.replace(os.path.join(src, "a", f), os.path.join(src, f"a-{f}"))
    ingest_daily_stream(spark, src, lake, ckpt)
    assert read_observation_lake(spark, lake).count() == 500
    ingest_daily_stream(spark, src, lake, ckpt)  # re-run: nothing new, nothing duplicated
    assert read_observation_lake(spark, lake).count() == 500
    write_daily_archive(_obs(spark, 2021, 300), os.path.join(base, "b"), by_year=False)
    for f in os.listdir(os.path.join(base, "b")):
        if f.startswith("part-"):
            os.replace(os.path.join(base, "b", f), os.path.join(src, f"b-{f}"))
    ingest_daily_stream(spark, src, lake, ckpt)
    lk = read_observation_lake(spark, lake)
    got = {r.YEAR: r["count"] for r in lk.groupBy("YEAR").count().collect()}
    assert got == {2020: 500, 2021: 300}
    assert set(lk.columns) >= {"ID", "DATE", "ELEMENT", "VALUE", "YEAR", "COUNTRY_CODE", "OBS_MINUTE"}


def test_a_batch_written_again_replaces_itself(spark):
    """What a restart after a failure does: the same batch id, the same rows."""
    lake = os.path.join(tempfile.mkdtemp(prefix="stratus-stream-"), "lake")
    for rows, batch in ((300, "x-0"), (300, "x-0"), (200, "x-1")):
        write_observation_lake(_obs(spark, 2020, rows).withColumn("OBV_TIME", F.lit("0700")), lake, batch=batch)
    obs = read_observation_lake(spark, lake)
    assert obs.count() == 500 and {r.OBS_MINUTE for r in obs.select("OBS_MINUTE").distinct().collect()} == {420}


def test_ingest_many_micro_batches(spark):
    base = tempfile.mkdtemp(prefix="stratus-stream-")
    src, lake, ckpt = (os.path.join(base, x) for x in ("src", "lake", "ckpt"))
    write_daily_archive(_obs(spark, 2019, 400).repartition(4), os.path.join(base, "parts"), by_year=False)
    os.makedirs(src)
    parts = [f for f in os.listdir(os.path.join(base, "parts")) if f.startswith("part-")]
    assert len(parts) == 4
    for f in parts:
        os.replace(os.path.join(base, "parts", f), os.path.join(src, f))
    q = ingest_daily_stream(spark, src, lake, ckpt, max_files_per_trigger=1)
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 4  # one file per micro-batch
    assert read_observation_lake(spark, lake).count() == 400
