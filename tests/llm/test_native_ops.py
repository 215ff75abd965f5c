"""Exact dedup, sharding, mixing and URL filters: edge cases and brute force."""

import collections
import hashlib
import math
import random
import zlib

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratus.llm import exact_dedup, mixing, sharding, url_filter
from stratus.llm.common import word_count
from stratus.llm.queries import ORACLE
from tools.check_oracle import digest


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


EDGE = [
    (1, None, "x", 1), (2, "", "x", 1), (3, "Ab É", "x", 1), (4, "aB É", "x", 1), (5, "ab é", None, None), (6, "word " * 20000, "x", 1),
    (6, "word " * 20000, "x", 1), (None, "ab É", "x", 1), (7, "İI", "x", 1), (8, "İi", "x", 1),
]
CLASH = ", keep_id string, shard int"


def test_exact_dedup_edges(frame):
    got = exact_dedup.exact_duplicates(frame(EDGE, CLASH)).collect()
    groups = collections.defaultdict(list)
    for d, t, *_ in EDGE:
        groups[hashlib.sha256(lower(t).encode()).hexdigest()].append(d)
    want = collections.Counter()
    for h, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[(i, keep, len(ids), i == keep, h)] += 1
    assert collections.Counter(map(tuple, got)) == want
    assert exact_dedup.exact_duplicates(frame([])).count() == 0


def test_exact_dedup_heavy_and_rest_agree(frame):
    """More groups than the sketch reports, one of them a third of all rows."""
    rows = [(i, "hot") for i in range(300)] + [(1000 + i, f"t{i % 250}") for i in range(600)]
    df = frame(rows).repartition(7)
    for heavy in (1, 5, 1000):
        got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_duplicates(df, heavy=heavy).collect()}
        assert got[0] == (299, 300) and all(got[1000 + i] == (1000 + max(j for j in range(600) if j % 250 == i % 250), len([j for j in range(600) if j % 250 == i % 250])) for i in range(0, 600, 37))


def test_frequent_digests_are_found(frame):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i}") for i in range(3000)]
    df = frame(rows).repartition(5).select(exact_dedup.text_digest(F.col("text")).alias("text_sha256"))
    top = {r[0] for r in exact_dedup.frequent_digests(df, heavy=10, tracked=64).collect()}
    assert hashlib.sha256(b"hot").hexdigest() in top and len(top) <= 10


# ------------------------------------------------------------- sharding
def rendezvous(key, weights):
    best = None
    for s, w in enumerate(weights):
        u = (int(hashlib.md5(f"{key}/{s}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
        score = w / -math.log(u)
        if best is None or score > best[0]:
            best = (score, s)
    return best[1]


def test_shards_by_brute_force_and_movement(spark):
    df = spark.range(4000).withColumnRenamed("id", "doc_id")
    weights = [1.0, 2.0, 0.0, 1.0]
    rows = sharding.shard_rows(df, weights, [*weights, 1.0], per_bucket=20).collect()
    assert all(r["shard"] == rendezvous(r.doc_id, weights) for r in rows[::13])
    moved = [r for r in rows if r["shard"] != r.grown_shard]
    assert all(r.grown_shard == 4 for r in moved) and 600 < len(moved) < 1000
    n = collections.Counter(r["shard"] for r in rows)
    assert n[2] == 0 and 1800 < n[1] < 2200
    for s in n:
        assert sorted(r.slot for r in rows if r["shard"] == s) == list(range(n[s]))
    again = {r.doc_id: tuple(r) for r in sharding.shard_rows(df.repartition(9), weights, [*weights, 1.0]).collect()}
    assert again == {r.doc_id: tuple(r) for r in rows}  # neither order, partitions nor buckets matter


def test_shard_edges(frame):
    df = frame([(None, "a", "x", 9), (None, "a", "x", 9), (1, None, None, None), (1, "", "y", 2)], ", slot string, shard int")
    out = sharding.shard_rows(df, [1.0, 1.0])
    assert out.columns == ["doc_id", "text", "slot", "shard", "shard_", "slot_", "grown_shard"]
    rows = out.collect()
    assert len(rows) == 4 and {r.grown_shard for r in rows} == {None}
    for s in (0, 1):
        assert sorted(r.slot_ for r in rows if r.shard_ == s) == list(range(sum(r.shard_ == s for r in rows)))
    assert sharding.shard_rows(frame([]), [1.0]).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_rows(frame([]), [0.0])


def test_shards_of_ids_that_repeat(spark):
    """A third of the rows have a null id, as many the id 7: gapless slots in the digests' order, from small buckets."""
    df = spark.range(3000).selectExpr("case id % 3 when 0 then null when 1 then 7 else id end as doc_id", "id as row")
    for grown in ([1.0] * 5, [2.0, 1.0, 1.0, 1.0, 1.0], [1.0] * 3):  # one more shard, other weights, one less
        rows = sharding.shard_rows(df, [1.0] * 4, grown, per_bucket=20).collect()
        assert sorted(r.row for r in rows) == list(range(3000))
        for r in rows[::97]:
            key = "null" if r.doc_id is None else r.doc_id
            assert (r["shard"], r.grown_shard) == (rendezvous(key, [1.0] * 4), rendezvous(key, grown))
        for s in range(4):
            of = sorted((r.slot, hashlib.md5(str("null" if r.doc_id is None else r.doc_id).encode()).hexdigest()) for r in rows if r["shard"] == s)
            assert [slot for slot, _ in of] == list(range(len(of))) and [d for _, d in of] == sorted(d for _, d in of)
    own = F.lpad(F.hex(F.xxhash64("row")), 16, "0")
    placed = df.select("doc_id", F.lit(0).alias("shard"), F.concat(sharding.id_digest("doc_id"), own).alias("order"))
    rows, sizes = sharding.labelled(placed, "shard", "order", 1, 20, ("label", "n", "wide"))
    got = {r.label: r.n for r in sizes.collect()}
    assert got == {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    assert sum(got.values()) == 3000 and max(got.values()) <= 4 * 20


# --------------------------------------------------------------- mixing
def test_word_count(frame):
    texts = [None, "", " ", "a", " a", "a ", "\ta\x0bb\r\n c ", "é b", "a\n"]
    got = frame([(i, t) for i, t in enumerate(texts)]).select(word_count(F.col("text")).alias("n")).collect()
    assert [r.n for r in got] == [0, 0, 0, 1, 1, 1, 3, 1, 1]


def targets(sizes, weights=(3, 1, 2)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full, out = 1.5 * sum(sizes.values()), set(), {}
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(2 * sizes[s] for s in full)
        out = {s: 2.0 * sizes[s] if s in full else left * w[s] / sum(w[x] for x in rest) for s in order}
        over = {s for s in rest if out[s] > 2 * sizes[s]}
        if not over:
            return out
        full |= over


def test_mix_reaches_targets(frame):
    rng = random.Random(2)
    rows = []
    for d in range(600):
        s = rng.choice(["a", "a", "a", "b", "ü", "Z", None, "tiny"]) if d else "tiny"
        s = "a" if s == "tiny" and d else s
        rows.append((d, " ".join(["w"] * rng.choice([0, 1, 5, 60, 400])) if d % 50 else None, s))
    mix = mixing.mix_sources(frame(rows, ", source string"), block=16)
    got = mix.taken().collect()
    assert len(got) == 600
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want, taken = targets(sizes), collections.Counter()
    for r in got:
        assert r.taken <= 2 * r.size and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert r.source_size == sizes[r.source]
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 16 * 4, s
    again = mixing.mix_sources(frame(rows, ", source string").repartition(5), block=16).taken()
    assert sorted(map(str, again.collect())) == sorted(map(str, got))
    # pieces: whole spans, each slot holds one block at most
    pieces = mix.pieces().collect()
    assert sum(r.to_word - r.from_word for r in pieces) == sum(taken.values())
    per_slot = collections.Counter()
    for r in pieces:
        per_slot[r.slot] += r.to_word - r.from_word
    assert max(per_slot.values()) <= 16
    # any run of slots is close to the targets (low discrepancy)
    source = {r.slot: r.source for r in pieces}
    run = [source.get(i) for i in range(200, 400)]
    for s in ("a", "b", "Z"):
        assert abs(run.count(s) / 200 - want[s] / sum(want.values())) < 0.04


def test_small_sources_beside_a_big_one_reach_their_targets(frame):
    """Targets of one to a few slots each, which the points serve late or not at all."""
    rng = random.Random(4)
    rows = [(d, "w " * 2000, "big") for d in range(100)]
    rows += [(1000 + i, "w " * rng.choice([300, 700, 1200]), f"s{i}") for i in range(300)]
    for weights, share in (((3, 1, 2), 1.5), ([3000] + [1] * 300, 0.5)):  # needs of 2 to 6 slots, and of 1
        mix = mixing.mix_sources(frame(rows, ", source string"), weights, share, block=500)
        target, taken = {}, collections.Counter()
        for r in mix.taken().collect():
            target[r.source] = r.target
            taken[r.source] += r.taken
        assert {s: taken[s] for s in target} == {s: math.ceil(t) for s, t in target.items()}
        slots = [r.slot for r in mix.slots.collect()]
        assert len(slots) == len(set(slots))


def test_mix_equals_its_sql_on_many_small_sources(spark, frame):
    """Hundreds of sources that the points serve late, null and repeated ids, blank texts."""
    rng = random.Random(9)
    rows = [(d, "w " * 3000, "big") for d in range(30)]
    rows += [(1000 + i, "v " * rng.choice([0, 40, 300, 700, 1200]), f"s{i:03d}") for i in range(400)]
    rows += [(None, f"n{i} " * rng.choice([1, 90]), None) for i in range(120)] + [(7, None, "s000")]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
    want = con.execute(ORACLE["op2_mix_sources"]).df()
    got = mixing.mix_sources(frame(rows, ", source string")).taken().toPandas()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(rows) and digest(got) == digest(want)
    assert got["taken"].sum() == want["taken"].sum() > 0


def test_mix_spreads_rows_that_share_an_id(frame):
    """A null id on most rows: their places in the stream come from many buckets."""
    rows = [(None, f"text {i} " * 3, "s") for i in range(400)]
    docs = frame(rows, ", source string").select("doc_id", "source", word_count(F.col("text")).alias("size"), mixing.row_digest("doc_id", "text").alias("digest"))
    placed = mixing.stream_positions(docs, per_bucket=10).collect()
    assert sorted(r.start for r in placed) == list(range(0, 2400, 6))
    assert len({r[0][0] for r in docs.select("digest").collect()}) == 16


def test_mix_takes_no_clashing_columns(frame):
    with pytest.raises(ValueError):
        mixing.mix_sources(frame([], ", source string, size int"), carry=("size",))


def test_mix_edges(frame):
    assert mixing.mix_sources(frame([], ", source string")).taken().count() == 0
    blank = mixing.mix_sources(frame([(1, None, "a"), (2, " ", None)], ", source string")).taken().collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in blank) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (None, "x y", "s"), (2, "", "s"), (2, "", "s")]
    got = mixing.mix_sources(frame(rows, ", source string")).taken().collect()
    assert len(got) == 5 and sum(r.taken for r in got) == 12


# ---------------------------------------------------------- URL filters
def test_url_parts(spark):
    urls = ["HTTP://User@WWW.Example.COM:80/a/b?x#y", "https://example.com", "ftp://h.org./p", "no url", None, "http://x", "https://a.b.c/?q"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    host, segment = url_filter.url_host(F.col("url")), url_filter.url_segment(F.col("url"))
    got = [tuple(r) for r in df.select(host, segment, url_filter.url_keys(host, segment)).collect()]
    assert got[0] == ("www.example.com", "a", ["www.example.com", "example.com", "www.example.com/a"])
    assert got[1] == ("example.com", None, ["example.com"])
    assert got[2][:2] == ("h.org", "p")
    assert got[3][0] is None and got[4][0] is None
    assert got[5] == ("x", None, ["x"])
    assert got[6] == ("a.b.c", None, ["a.b.c", "b.c"])


def test_intervals_and_precedence(spark):
    day = "day string"
    entries = spark.createDataFrame(
        [("spam", "b.com", "add", "2020-01-10"), ("spam", "b.com", "remove", "2020-02-01"), ("spam", "b.com", "add", "2020-03-01"),
         ("spam", "b.com", "add", "2020-03-05"), ("allow", "b.com", "add", "2020-03-10"), ("bad", "a.b.com", "add", "2020-03-20"),
         ("bad", "c.com", "add", "2020-01-01"), ("bad", "c.com", "remove", "2020-01-01"), (None, "b.com", "add", "2020-01-01"),
         ("spam", None, "add", "2020-01-01"), ("spam", "b.com", "add", None), ("spam", "b.com", "odd", "2020-01-20")],
        "list string, key string, action string, " + day,
    ).withColumn("day", F.col("day").cast("date"))
    held = {(r.list, r.key, str(r.since), str(r.until)) for r in url_filter.validity(entries).collect()}
    assert held == {
        ("spam", "b.com", "2020-01-10", "2020-02-01"), ("spam", "b.com", "2020-03-01", "2020-03-05"), ("spam", "b.com", "2020-03-05", "None"),
        ("allow", "b.com", "2020-03-10", "None"), ("bad", "a.b.com", "2020-03-20", "None"),
    }
    captures = [
        (1, "http://a.b.com/x", "2020-01-09", "h"), (2, "http://a.b.com/x", "2020-01-10", "h"), (3, "http://a.b.com/x", "2020-02-01", "h"),
        (4, "http://a.b.com/x", "2020-03-06", "h"), (5, "http://a.b.com/x", "2020-03-10", "h"), (6, "http://a.b.com/x", "2020-03-20", "h"),
        (7, "http://c.com", "2020-01-01", "h"), (8, None, "2020-01-10", "h"), (9, "http://b.com", None, "h"), (2, "http://a.b.com/x", "2020-01-10", "h"),
    ]
    df = spark.createDataFrame(captures, "page_id long, url string, fetched string, host string").withColumn("fetched", F.col("fetched").cast("date"))
    out = url_filter.filter_captures(df, entries)
    assert out.columns == ["page_id", "url", "fetched", "host", "host_", "verdict", "list", "list_key", "since"]
    got = sorted((r.page_id, r.verdict, r.list) for r in out.collect())
    assert got == [
        (1, "none", None), (2, "block", "spam"), (2, "block", "spam"), (3, "none", None), (4, "block", "spam"), (5, "allow", "allow"),
        (6, "block", "bad"), (7, "none", None), (8, "none", None), (9, "none", None),
    ]
    assert url_filter.filter_captures(df.limit(0), entries).count() == 0
    assert {r.verdict for r in url_filter.filter_captures(df, entries.limit(0)).collect()} == {"none"}


def test_crc_is_unsigned_utf8(frame):
    r = frame([(1, "é")]).select(F.crc32(F.col("text").cast("binary")).alias("c")).first()
    assert r.c == zlib.crc32("é".encode())
