"""Golden values for the column functions (haversine, time of day, text)."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.functions.columns import array_text, obs_minute, year_int, year_text
from stratus.functions.geo import haversine_km

# Published distances: coordinates are 32-bit floats widened to double.
GOLDEN = [
    (34.85, 5.72, 36.383, 3.883, 237.9625309815391),
    (-42.717, 170.983, -37.0, 174.8, 714.1268050318199),
    (-42.717, 170.983, -43.95, -176.567, 1015.2499467565266),
    (41.1, 49.2, -17.8, 128.3, 10423.75403335335),
    (0.0, 0.0, 0.0, 180.0, 20015.086796020572),
]


def test_haversine_golden_float_inputs(spark):
    schema = T.StructType([T.StructField(n, T.FloatType()) for n in ("a", "b", "c", "d")] + [T.StructField("km", T.DoubleType())])
    df = spark.createDataFrame(GOLDEN, schema)
    got = df.select(haversine_km("a", "b", "c", "d").alias("x"), "km").collect()
    for r in got:
        assert r.x == pytest.approx(r.km, abs=1e-9)


def test_haversine_not_swapped_and_symmetric(spark):
    df = spark.createDataFrame([(-42.717, 170.983, -37.0, 174.8)], "a float, b float, c float, d float")
    r = df.select(haversine_km("a", "b", "c", "d").alias("x"), haversine_km("c", "d", "a", "b").alias("y")).first()
    assert r.x == pytest.approx(714.1268050318199, abs=1e-9)
    assert abs(r.x - 760.2041153505343) > 1  # the swapped-argument value
    assert r.x == pytest.approx(r.y, abs=1e-9)


def test_haversine_null_and_bounds(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0, 3.0), (90.0, 0.0, -90.0, 0.0)], "a double, b double, c double, d double")
    r = df.select(haversine_km("a", "b", "c", "d").alias("x")).collect()
    assert r[0].x is None
    assert r[1].x == pytest.approx(math.pi * 6371, abs=1e-6)


@pytest.mark.parametrize(
    "text,minute",
    [("0000", 0), ("0700", 420), ("1200", 720), ("1800", 1080), ("2359", 1439), ("2400", 1440),
     ("2401", None), ("9999", None), ("0760", None), ("", None), (None, None), ("12a0", None), ("700", None)],
)
def test_obs_minute(spark, text, minute):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(obs_minute("t").alias("m")).first().m == minute


def test_year_and_array_text(spark):
    df = spark.createDataFrame([("2010-01-05", ["b", "a"]), ("1999-12-31", None)], "d string, arr array<string>")
    df = df.select(F.col("d").cast("date").alias("d"), "arr")
    rows = df.select(year_int("d").alias("y"), year_text("d").alias("t"), array_text("arr").alias("s")).collect()
    assert [(r.y, r.t, r.s) for r in rows] == [(2010, "2010", "a,b"), (1999, "1999", None)]
