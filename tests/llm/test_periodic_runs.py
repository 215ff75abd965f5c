"""op12: runs of repeated words against a plain search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from stratus.llm import periodic_runs as pr
from stratus.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """(start, length, period) of every run, by comparing the words with themselves at every distance."""
    number = {}
    x = np.array([number.setdefault(w, len(number)) for w in words])
    n, found = len(x), {}
    for q in range(1, n // pr.PERIODS + 1):
        same = np.concatenate([[0], (x[q:] == x[:-q]).astype(np.int8), [0]])
        edges = np.flatnonzero(np.diff(same))
        for lo, hi in zip(edges[::2], edges[1::2]):
            length = int(hi - lo) + q
            if length >= max(pr.LEAST, pr.PERIODS * q):
                found.setdefault((int(lo), length), q)  # the smallest period comes first
    return sorted((s, n_, q) for (s, n_), q in found.items())


def brute_collapsed(words, runs):
    gone = set()
    for s, n, q in runs:
        gone.update(range(s + q, s + n))
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def local_runs(texts):
    """The operator's steps in one process."""
    words, numbers, first = pr.number_words([" ".join(t).encode() for t in texts])
    found = [set() for _ in texts]
    for t, tile in pr.tiles_of(numbers, first):
        found[t].update(pr.fragments(tile["octave"], list(tile["boundaries"]), list(tile["words"]), tile["start"], len(words[t])))
    out = []
    for f in found:
        whole = [x for x in pr._joined(list(f)) if x[2] - x[1] >= max(pr.LEAST, pr.PERIODS * x[0])]
        out.append(sorted((lo, hi - lo, q) for q, lo, hi in whole))
    return out


def periodic(rnd, letters, most):
    """Words with repeats of random blocks, some of them nested, at random places."""
    out = []
    while len(out) < most:
        block = [rnd.choice(letters) for _ in range(rnd.choice((1, 2, 3, 5, 8, 13, 40)))]
        if rnd.random() < 0.3:
            block = block * rnd.randint(2, 5) + [rnd.choice(letters)]
        times = rnd.choice((1, 1, 2, 3.5, 4, 4.3, 5, 9, 30))
        out += (block * (int(times) + 1))[: int(len(block) * times)]
    return out[:most]


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    texts = [periodic(rnd, "ab" if i % 3 == 0 else "abcdefghij", rnd.choice((0, 3, 7, 30, 200, 900))) for i in range(150)]
    for t, got in zip(texts, local_runs(texts)):
        assert got == brute_runs(t)


def test_every_length_and_period():
    """One run between other words, with every period to 70 and lengths about the least one, at every boundary offset."""
    rnd = random.Random(1)
    texts = []
    for q in range(1, 71):
        block = [f"b{i}" for i in range(q)]
        for extra in (-1, 0, 1, q // 2, 3 * q, 40 * q):
            before = [f"x{i}" for i in range(rnd.randint(0, 3 * q))]
            texts.append(before + (block * 60)[: 4 * q + extra] + [f"y{i}" for i in range(rnd.randint(0, 9))])
    for t, got in zip(texts, local_runs(texts)):
        assert got == brute_runs(t)


def test_wide_numbers_equal_packed_ones():
    rnd = np.random.default_rng(3)
    a, b = rnd.integers(0, 9, 500), rnd.integers(0, 3, 500)
    for x, y in zip(pr._numbered(np.arange(500), a, b, 500), pr._numbered(np.arange(500), a, b, 2**40)):
        assert (x == y).all()


def test_operator_stitches_tiles_over_tasks(spark):
    """A run of thousands of tiles, and a text in which a third of all words is one word."""
    rnd = random.Random(7)
    long = [f"w{rnd.randrange(10**6)}" for _ in range(300)] + ["same"] * 20_000 + [f"z{i % 700}" for i in range(9_000)]
    texts = {1: long, 2: periodic(rnd, "abc", 3000), 3: [f"v{i}" for i in range(100)]}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    for r in pr.find_runs(docs).collect():
        want = brute_runs(texts[r.doc_id])
        assert [(x.start, x.length, x.period) for x in r.runs] == want
        assert r.collapsed == brute_collapsed(texts[r.doc_id], want) and r.n_words == len(texts[r.doc_id])


def test_edges(spark):
    """Null, empty and blank texts, null and repeated ids, clashing columns, an empty table."""
    rows = [(None, "a a a a a a b", 1), (7, None, 2), (7, "", 3), (7, " \t\n ", 4), (7, "x  x\tx\nx x x x", 5), (7, "x  x\tx\nx x x x", 5)]
    docs = spark.createDataFrame(rows, "id long, text string, runs int").withColumns({"row": pr.F.lit(1), "tiles": pr.F.lit(2)})
    out = sorted((str(r.id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in pr.find_runs(docs, id_col="id").collect())
    assert out == sorted(
        [("None", 7, [(0, 6, 1)], "a b"), *[("7", 0, [], "")] * 3, *[("7", 7, [(0, 7, 1)], "x")] * 2]
    )
    assert pr.find_runs(docs.limit(0), id_col="id").collect() == []


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    planted = 0
    for d in docs:
        words = WORD.findall(d.text or "")
        n, h = len(words), zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs, r = brute_runs(words), got[d.doc_id]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()
        best = None
        for s, m, q in runs:
            if best is None or m * best[2] > best[1] * q:
                best = (s, m, q)
        if best:
            assert (r.start, r.length, r.period, r.exponent_milli) == (*best, 1000 * best[1] // best[2])
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
    assert planted > 5
