"""Operator semantics, including the decisions on the reference's defects."""

import itertools
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from stratus.operators import observations as ob
from stratus.operators import pairs as pr
from stratus.operators import quality as qa
from stratus.operators import stations as stn

INV_SCHEMA = "ID string, ELEMENT string, FIRSTYEAR int, LASTYEAR int"


def test_profile_zero_not_null(spark):
    inv = spark.createDataFrame(
        [("A", "PRCP", 1950, 1960), ("A", "TMAX", 1940, 1970), ("B", "TAVG", 1990, 2000), ("B", "WT01", 1991, 2001),
         ("C", "PRCP", 2000, 2021), ("C", "PRCP", 1999, 2020)],
        INV_SCHEMA,
    )
    prof = {r.ID: r for r in stn.inventory_profile(inv).collect()}
    # a station with only non-core elements gets 0 core (not null), and the
    # reverse; the set is sorted and deduplicated
    assert (prof["B"].num_cElement, prof["B"].num_nElement) == (0, 2)
    assert (prof["C"].num_cElement, prof["C"].num_nElement, prof["C"].ELEMENT_SET) == (1, 0, ["PRCP"])
    assert (prof["A"].Firstyear, prof["A"].Lastyear, prof["A"].ELEMENT_NUMBER) == (1940, 1970, 2)
    only = [r.ID for r in stn.stations_with_only(inv, "PRCP").collect()]
    assert only == ["C"]
    allc = [r.ID for r in stn.stations_with_all(inv, ["PRCP", "TMAX"]).collect()]
    assert allc == ["A"]


def test_enrich_keeps_stations_without_inventory(spark):
    st = spark.createDataFrame(
        [("AB1", 1.0, 2.0, 3.0, "", "N1", "GSN", "", "1"), ("CD2", -1.0, 2.0, 3.0, "XX", "N2", "", "HCN", "")],
        "ID string, LATITUDE double, LONGITUDE double, ELEVATION double, STATE string, NAME string, GFLAG string, HCFLAG string, WMOID string",
    )
    cty = spark.createDataFrame([("AB", "Country AB")], "CODE string, COUNTRY_NAME string")
    sta = spark.createDataFrame([("XX", "State XX")], "CODE string, STATE_NAME string")
    inv = spark.createDataFrame([("AB1", "PRCP", 1950, 1960)], INV_SCHEMA)
    e = {r.STATION_ID: r for r in stn.enrich_stations(st, cty, sta, inv).collect()}
    assert len(e) == 2
    assert e["AB1"].COUNTRY_NAME == "Country AB" and e["AB1"].STATE_NAME is None and e["AB1"].num_nElement == 0
    assert e["CD2"].COUNTRY_NAME is None and e["CD2"].STATE_NAME == "State XX" and e["CD2"].num_cElement is None


def test_multi_network_counts_memberships(spark):
    # GSN+HCN, GSN+CRN count; CRN alone does not (the A & B | C precedence slip)
    st = spark.createDataFrame(
        [("a", "GSN", "HCN"), ("b", "GSN", "CRN"), ("c", "", "CRN"), ("d", "GSN", ""), ("e", "", "")],
        "ID string, GFLAG string, HCFLAG string",
    )
    assert sorted(r.ID for r in stn.multi_network_stations(st).collect()) == ["a", "b"]


def test_dimension_preserving_counts(spark):
    dim = spark.createDataFrame([("AA", "a"), ("BB", "b")], "CODE string, STATE_NAME string")
    st = spark.createDataFrame([("1", "AA"), ("2", "AA"), ("3", "")], "ID string, STATE string")
    got = {r.CODE: r.station_count for r in stn.stations_per_area(dim, st, "STATE", "STATE_NAME").collect()}
    assert got == {"AA": 2, "BB": None}


def test_tmin_without_tmax_two_ways(spark):
    import datetime as dt

    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 1, 2)
    obs = spark.createDataFrame(
        [("s", d1, "TMIN", 1.0), ("s", d1, "TMIN", 2.0), ("s", d2, "TMIN", 1.0), ("s", d2, "TMAX", 3.0),
         ("t", d1, "TMAX", 1.0), ("u", d1, "TMIN", 0.0), ("u", d1, "PRCP", 0.0)],
        "ID string, DATE date, ELEMENT string, VALUE double",
    )
    a = sorted(tuple(r) for r in ob.station_days_missing(obs).collect())
    b = sorted(tuple(r) for r in ob.station_days_except(obs).collect())
    assert a == b == [("s", d1), ("u", d1)]


def test_orphans_and_match_count(spark):
    fact = spark.createDataFrame([("a",), ("a",), ("b",), ("z",)], "ID string")
    dim = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "ID string")
    assert [r.ID for r in qa.orphans(fact, dim, "ID", "ID").collect()] == ["z"]
    assert [r.ID for r in qa.orphan_keys(dim, fact, "ID", "ID").collect()] == ["c"]
    m = qa.match_count(fact, dim, "ID", "ID").first()
    assert (m.total_rows, m.matched_rows) == (4, 3)


def _random_points(n, seed, clusters=False):
    rnd = random.Random(seed)
    pts = []
    for i in range(n):
        if clusters and i % 3 == 0:
            lat, lon = 10 + rnd.random() * 0.01, 20 + rnd.random() * 0.01
        else:
            lat, lon = rnd.uniform(-89, 89), rnd.uniform(-180, 180)
        pts.append((f"{'AB' if i % 2 else 'CD'}{i:05d}", "AB" if i % 2 else "CD", lat, lon))
    return pts


def _hav(a, b):
    la1, lo1, la2, lo2 = map(math.radians, (a[2], a[3], b[2], b[3]))
    h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, h)))


@pytest.mark.parametrize("rows_per_block", [1, 3, 1000])
def test_country_pairs_blocked_matches_all_pairs(spark, rows_per_block):
    pts = _random_points(41, 7)
    df = spark.createDataFrame(pts, "ID string, COUNTRY_CODE string, LATITUDE double, LONGITUDE double")
    got = pr.country_pairs(df, rows_per_block=rows_per_block).collect()
    want = {(a[0], b[0]) for a, b in itertools.combinations(sorted(pts), 2) if a[1] == b[1]}
    keys = [(r.ID, r.ID_1) for r in got]
    assert len(keys) == len(set(keys)) == len(want) and set(keys) == want
    for r in got[:20]:
        a = next(p for p in pts if p[0] == r.ID)
        b = next(p for p in pts if p[0] == r.ID_1)
        assert r.distance_km == pytest.approx(_hav(a, b), abs=1e-9)


def test_ordered_pairs_count(spark):
    df = spark.createDataFrame(_random_points(10, 3), "ID string, COUNTRY_CODE string, LATITUDE double, LONGITUDE double")
    got = pr.ordered_pairs(df, rows_per_block=2).collect()
    assert len(got) == 90 and len({(r.ID, r.ID_1) for r in got}) == 90


@pytest.mark.parametrize("seed,clusters", [(1, False), (2, True), (3, True)])
def test_closest_pairs_equals_brute_force(spark, seed, clusters):
    pts = _random_points(120, seed, clusters)
    # coincident stations: the smallest ids at the spot must win at distance 0
    if seed == 3:
        pts += [("AB90001", "AB", 5.0, 5.0), ("AB90003", "AB", 5.0, 5.0), ("AB90005", "AB", 5.0, 5.0)]
    df = spark.createDataFrame(pts, "ID string, COUNTRY_CODE string, LATITUDE double, LONGITUDE double")
    got = {r.COUNTRY_CODE: (r.ID, r.ID_1, r.distance_km) for r in pr.closest_pairs(df).collect()}
    for cc in ("AB", "CD"):
        grp = sorted(p for p in pts if p[1] == cc)
        best = min(((_hav(a, b), a[0], b[0]) for a, b in itertools.combinations(grp, 2)))
        assert got[cc][0:2] == best[1:3]
        assert got[cc][2] == pytest.approx(best[0], abs=1e-9)


def test_closest_pair_across_antimeridian_and_pole(spark):
    pts = [("a", "X", 0.0, 179.999), ("b", "X", 0.0, -179.999), ("c", "X", 0.0, 0.0),
           ("d", "X", 89.9999, 0.0), ("e", "X", 89.9999, 180.0)]
    df = spark.createDataFrame(pts, "ID string, COUNTRY_CODE string, LATITUDE double, LONGITUDE double")
    r = pr.closest_pair(df).first()
    assert (r.ID, r.ID_1) == ("d", "e") and r.distance_km < 0.03


def test_closest_pair_sparse_group(spark):
    # three stations in different octants, one station alone in its group
    pts = [("a", "X", 45.0, 45.0), ("b", "X", -45.0, -135.0), ("c", "X", 10.0, 100.0), ("d", "Y", 0.0, 0.0)]
    df = spark.createDataFrame(pts, "ID string, COUNTRY_CODE string, LATITUDE double, LONGITUDE double")
    got = {r.COUNTRY_CODE: (r.ID, r.ID_1) for r in pr.closest_pairs(df).collect()}
    want = min(((_hav(a, b), a[0], b[0]) for a, b in itertools.combinations(pts[:3], 2)))
    assert got == {"X": want[1:3]}


def test_hot_group_pairs_and_closest(spark):
    """One country with 3,000 clustered stations (plus a few elsewhere):
    the blocked join spreads it over block pairs, and the grid search
    finds the same minimum as the full pair table."""
    n = 3000
    pts = spark.range(n).select(
        F.format_string("HT%09d", F.col("id")).alias("ID"),
        F.when(F.col("id") < n - 5, F.lit("HT")).otherwise(F.lit("LO")).alias("COUNTRY_CODE"),
        (F.lit(-41.0) + (F.xxhash64("id") % 100000) / 1e5).alias("LATITUDE"),
        (F.lit(174.0) + (F.xxhash64(F.col("id") + 7) % 100000) / 1e5).alias("LONGITUDE"),
    )
    pairs = pr.country_pairs(pts, rows_per_block=400)
    counts = {r.COUNTRY_CODE: r["count"] for r in pairs.groupBy("COUNTRY_CODE").count().collect()}
    assert counts == {"HT": (n - 5) * (n - 6) // 2, "LO": 10}
    brute = {
        r.COUNTRY_CODE: (r.m.distance_km, r.m.ID, r.m.ID_1)
        for r in pairs.groupBy("COUNTRY_CODE").agg(F.min(F.struct("distance_km", "ID", "ID_1")).alias("m")).collect()
    }
    grid = {r.COUNTRY_CODE: (r.distance_km, r.ID, r.ID_1) for r in pr.closest_pairs(pts).collect()}
    assert set(grid) == set(brute)
    for cc in grid:
        assert grid[cc][1:] == brute[cc][1:]
        assert grid[cc][0] == pytest.approx(brute[cc][0], abs=1e-9)


def test_closest_pair_many_coincident_stations(spark):
    """3,000 stations at one spot (a third of the group) plus scattered ones:
    the spot is reduced to its two smallest ids before the cell join."""
    n = 9000
    spot = F.col("id") % 3 == 0
    pts = spark.range(n).select(
        F.format_string("CC%09d", F.col("id")).alias("ID"),
        F.lit("CC").alias("COUNTRY_CODE"),
        F.when(spot, F.lit(12.5)).otherwise((F.xxhash64("id") % 170000) / 1e3).alias("LATITUDE"),
        F.when(spot, F.lit(-3.25)).otherwise((F.xxhash64(F.col("id") + 1) % 179000) / 1e3).alias("LONGITUDE"),
    )
    r = pr.closest_pair(pts).first()
    assert (r.ID, r.ID_1, r.distance_km) == ("CC000000000", "CC000000003", 0.0)


def test_lookup_key_must_be_unique(spark):
    from stratus.operators.joins import lookup_join

    fact = spark.range(100).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    dim = spark.range(10).select(F.col("id").alias("k"), F.format_string("n%d", "id").alias("name"))
    assert lookup_join(fact, dim, "k").filter(F.col("name") == F.format_string("n%d", "k")).count() == 100
    with pytest.raises(Exception, match="k is not unique: 3"):
        lookup_join(fact, dim.union(dim.filter("k = 3")), "k").collect()


def test_lookup_join_shuffles_beyond_the_broadcast_bound(spark):
    from stratus.operators.joins import lookup_join

    fact = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    dim = spark.range(10).select(F.col("id").alias("k"), F.format_string("n%d", "id").alias("name"))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        df = lookup_join(fact, dim, "k")
        assert df.count() == 1000 and "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_hot_country_pairs_are_spread_over_tasks(spark):
    """One country holds nearly all stations; broadcasts are at their default."""
    n = 3000
    pts = spark.range(n).select(
        F.format_string("HT%09d", F.col("id")).alias("ID"), F.lit("HT").alias("COUNTRY_CODE"),
        ((F.col("id") * 7919 % 18000) / 100 - 90).alias("LATITUDE"), ((F.col("id") * 104729 % 36000) / 100 - 180).alias("LONGITUDE"),
    )
    pairs = pr.country_pairs(pts.coalesce(1), rows_per_block=250)
    per_task = [r["n"] for r in pairs.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    total = n * (n - 1) // 2
    assert sum(per_task) == total
    assert len(per_task) >= 6 and max(per_task) < 0.4 * total


@pytest.mark.parametrize("broadcast_bound", ["10485760", "-1"])
def test_copies_for_country_pairs_are_dealt_and_in_order(spark, broadcast_bound):
    """30 blocks of one country: 15 copies of a station, which estimates of sizes do not see."""
    n, block = 300, 10
    pts = spark.range(0, n + 3, 1, 4).select(
        F.format_string("HT%09d", F.col("id")).alias("ID"),
        F.when(F.col("id") < n, "HT").when(F.col("id") < n + 2, "LO").alias("COUNTRY_CODE"),  # the last has none
        ((F.col("id") * 7919 % 18000) / 100 - 90).alias("LATITUDE"), ((F.col("id") * 104729 % 36000) / 100 - 180).alias("LONGITUDE"),
    )
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, broadcast_bound)
    try:
        pairs = pr.country_pairs(pts, rows_per_block=block)
        plan = pairs._jdf.queryExecution().executedPlan().toString().splitlines()
        rows = pairs.select(F.spark_partition_id(), "COUNTRY_CODE", "ID", "ID_1").collect()
    finally:
        spark.conf.set(key, old)
    # copies meet without a broadcast, are made after their stations are dealt, and are dealt once
    assert "SortMergeJoin" in next(line for line in plan if "Join" in line)
    copies = [i for i, line in enumerate(plan) if "Generate explode" in line]
    assert len(copies) == 2 and all("REPARTITION_BY_NUM" in plan[i + 1] for i in copies)
    assert sum("REPARTITION_BY_NUM" in line for line in plan) == 4 and not any("ENSURE_REQUIREMENTS" in line and "_key" in line for line in plan)
    assert sum(r.COUNTRY_CODE == "HT" for r in rows) == len({r[2:] for r in rows if r.COUNTRY_CODE == "HT"}) == n * (n - 1) // 2
    assert [r[1:] for r in rows if r.COUNTRY_CODE != "HT"] == [("LO", f"HT{n:09d}", f"HT{n + 1:09d}")]
    # one of the ids stays but for two breaks per copy of a station, and the other one rises
    breaks = rises = 0
    for a, b in itertools.pairwise(rows):
        breaks += a[0] != b[0] or (a.ID != b.ID and a.ID_1 != b.ID_1)
        rises += a[0] == b[0] and ((a.ID == b.ID and a.ID_1 < b.ID_1) or (a.ID_1 == b.ID_1 and a.ID < b.ID))
    assert breaks <= 2 * n * (n // block + 1) / 2 and breaks + rises == len(rows) - 1


@pytest.mark.parametrize("place", ["packed", "pole"])
def test_closest_pair_of_packed_stations_is_no_slower(spark, place):
    """20,000 stations inside a metre, or on a pole, against 20,000 spread ones."""
    n = 20_000
    a, b = (F.col("id") * 7919 % n) / n, (F.col("id") * 104729 % n) / n
    where = {
        "spread": (a * 179 - 89.5, b * 359 - 179.5),
        "packed": (a * 1e-5 + 10, b * 1e-5 + 20),
        "pole": (F.lit(90.0), b * 359 - 179.5),
    }

    def run(kind):
        lat, lon = where[kind]
        pts = spark.range(n).select(
            F.format_string("XX%09d", "id").alias("ID"), F.lit("XX").alias("COUNTRY_CODE"), lat.alias("LATITUDE"), lon.alias("LONGITUDE")
        )
        t = time.perf_counter()
        r = pr.closest_pair(pts).first()
        return time.perf_counter() - t, r

    run("spread")
    spread, _ = run("spread")
    took, r = run(place)
    assert took < 3 * spread + 3
    if place == "pole":
        assert (r.ID, r.ID_1) == ("XX000000000", "XX000000001") and r.distance_km < 1e-9


def test_two_set_pairs(spark):
    pts = _random_points(30, 3)
    df = spark.createDataFrame(pts, "ID string, COUNTRY_CODE string, LATITUDE double, LONGITUDE double")
    a, b = df.orderBy("ID").limit(12), df.orderBy(F.desc("ID")).limit(20)
    ids = sorted(p[0] for p in pts)
    got = [(r.ID, r.ID_1) for r in pr.two_set_pairs(a, b, rows_per_block=4).collect()]
    assert len(got) == len(set(got)) and set(got) == {(x, y) for x in ids[:12] for y in ids[-20:] if x != y}
