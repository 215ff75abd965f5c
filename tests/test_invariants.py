"""Invariants between queries (the reference checks results this way too)."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from stratus.functions.columns import obs_minute
from stratus.operators import quality as qa
from stratus.plans import fixtures as fx

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def q(spark):
    qs = E.queries()
    return lambda k: qs[k](spark, SF)


def test_left_joins_keep_rows(spark, q):
    n = fx.fx_station(spark, SF).count()
    assert q("enrich_stations").count() == n == q("join_left_state").count() == q("agg_conditional_distinct").count()
    assert qa.duplicate_keys(fx.fx_state(spark, SF), "CODE").count() == 0  # state lookup key is unique
    assert qa.duplicate_keys(fx.fx_station(spark, SF), "ID").count() == 0


def test_pairs_and_closest(spark, q):
    n = fx.fx_station(spark, SF).filter(F.substring("ID", 1, 2) == "07").count()
    pairs = q("geo_country_pairs")
    assert pairs.count() == n * (n - 1) // 2
    lo, hi = pairs.agg(F.min("distance_km"), F.max("distance_km")).first()
    assert 0 <= lo and hi <= math.pi * 6371 + 1e-6
    best = q("geo_closest_pair").first()
    assert best.distance_km == pytest.approx(lo, abs=1e-6)
    cross = q("join_cross_self")
    assert cross.count() == 90
    sym = cross.alias("a").join(cross.alias("b"), (F.col("a.ID") == F.col("b.ID_1")) & (F.col("a.ID_1") == F.col("b.ID")))
    assert sym.filter(F.abs(F.col("a.distance_km") - F.col("b.distance_km")) > 1e-9).count() == 0


def test_two_ways_and_totals(spark, q):
    a = {tuple(r) for r in q("set_except_tmin_tmax").collect()}
    b = {tuple(r) for r in q("tmin_without_tmax").collect()}
    assert a == b and len(a) == 1018
    assert q("tmin_without_tmax_stations").first().station_count == len({x[0] for x in a}) == 150
    total = q("flt_isin").count()
    assert total == 7986 == q("core_element_counts").agg(F.sum("observation_count")).first()[0]
    assert total + q("flt_not_isin").count() == fx.fx_obs(spark, SF).count()


def test_anti_join_both_directions(spark, q):
    # every observed id is a station (0 rows), and 1,350 stations are never observed
    assert qa.orphans(fx.fx_obs(spark, SF), fx.fx_station(spark, SF), "ID", "ID").count() == 0
    assert q("join_left_anti").count() == 1350
    m = q("join_left_count_check").first()
    assert m.total_rows == m.matched_rows == 10000


def _model(t):
    if t is None or len(t.strip()) != 4 or not t.strip().isdigit():
        return None
    hh, mm = int(t.strip()[:2]), int(t.strip()[2:])
    if mm >= 60 or hh > 24 or (hh == 24 and mm != 0):
        return None
    return hh * 60 + mm


@settings(max_examples=15, deadline=None, derandomize=True)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789 a-", max_size=6)), min_size=20, max_size=60))
def test_obs_minute_matches_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    got = {r.i: r.m for r in df.select("i", obs_minute("t").alias("m")).collect()}
    assert got == {i: _model(v) for i, v in enumerate(values)}


@settings(max_examples=8, deadline=None, derandomize=True)
@given(
    st.lists(st.tuples(st.sampled_from("ABC"), st.integers(0, 60)), min_size=0, max_size=80),
    st.integers(1, 7),
)
def test_blocked_pairs_property(spark, rows, rows_per_block):
    from stratus.operators.pairs import pairs_in_groups

    df = spark.createDataFrame([(g, f"{g}{i:03d}") for g, i in rows] or [("A", "A000")][:0], "G string, ID string")
    got = [(r.G, r.ID, r.ID_1) for r in pairs_in_groups(df, "G", "ID", rows_per_block).collect()]
    want = sorted(
        (a[0], f"{a[0]}{a[1]:03d}", f"{b[0]}{b[1]:03d}")
        for i, a in enumerate(rows)
        for b in rows[i + 1 :] + rows[:i]
        if a[0] == b[0] and f"{a[0]}{a[1]:03d}" < f"{b[0]}{b[1]:03d}"
    )
    # duplicates of an id pair appear once per row combination, like the SQL self join
    assert sorted(got) == want


_coord = st.tuples(
    st.sampled_from(["AA", "BB"]),
    st.sampled_from([-90.0, -45.5, 0.0, 10.25, 10.2501, 89.99, 90.0]) | st.floats(-90, 90, allow_nan=False),
    st.sampled_from([-180.0, -179.999, 0.0, 179.999, 180.0]) | st.floats(-180, 180, allow_nan=False),
)


@settings(max_examples=6, deadline=None, derandomize=True)
@given(st.lists(_coord, min_size=2, max_size=40))
def test_closest_pairs_property(spark, pts):
    from stratus.operators.pairs import closest_pairs

    rows = [(f"{g}{i:03d}", g, lat, lon) for i, (g, lat, lon) in enumerate(pts)]
    df = spark.createDataFrame(rows, "ID string, COUNTRY_CODE string, LATITUDE double, LONGITUDE double")
    got = {r.COUNTRY_CODE: (r.distance_km, r.ID, r.ID_1) for r in closest_pairs(df).collect()}

    def hav(a, b):
        la1, lo1, la2, lo2 = map(math.radians, (a[2], a[3], b[2], b[3]))
        h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
        return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, h)))

    for g in ("AA", "BB"):
        grp = [r for r in rows if r[1] == g]
        if len(grp) < 2:
            assert g not in got
            continue
        best = min((hav(a, b), a[0], b[0]) for i, a in enumerate(grp) for b in grp[i + 1 :])
        d, i1, i2 = got[g]
        assert d == pytest.approx(best[0], abs=1e-7)
        # same pair, unless another pair ties within floating-point noise
        if (i1, i2) != best[1:]:
            a = next(r for r in grp if r[0] == i1)
            b = next(r for r in grp if r[0] == i2)
            assert abs(hav(a, b) - best[0]) < 1e-7


def test_fixture_expectations(spark, q):
    """Remaining expected values of FIXTURES.md at sf0.01."""
    cd = q("agg_conditional_distinct")
    assert cd.filter((F.col("core_count") == 0) & (F.col("other_count") > 0)).count() == 3  # D6 case
    assert cd.filter(F.col("core_count").isNull()).count() == 0  # every station has inventory here
    assert q("stations_per_state").filter(F.col("station_count").isNull()).count() == 1
    assert q("join_left_state").filter(F.col("STATE_NAME").isNull()).count() == 500
    assert fx.fx_station(spark, SF).filter(F.substring("ID", 1, 2) == "07").count() == 73
    s = q("station_summary").first()
    assert (s.total, s.active_2001, s.no_wmo, s.gsn, s.hcn, s.crn, s.multi_network, s.northern) == (
        1500, 885, 1125, 300, 215, 215, 86, 750)
    assert q("rainfall_country_year").count() == 175 and q("years_covered").first().year_count == 7
