import random
import re

import numpy as np
import pytest

from stratus.llm import ngram_join as nj
from stratus.llm.components import connected_components


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def sets_of(text, width=5):
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def brute(rows):
    sets = {d: sets_of(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {(d, len(sets[d]), find(d)) for d in ids}


def near_copies(rng, n):
    """Texts of all lengths with edited copies of copies, shared passages and repeats."""
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows = []
    for _ in range(n):
        kind = rng.random()
        if rows and kind < 0.55:
            w = words(rng.choice(rows[-60:])[1])
            for _ in range(rng.randint(0, max(1, len(w) // 40))):
                if not w:
                    break
                i = rng.randrange(len(w))
                edit = rng.random()
                w[i : i + 1] = [] if edit < 0.3 else [rng.choice(vocab)] if edit < 0.7 else [w[i], rng.choice(vocab)]
        else:
            w = [rng.choice(vocab) for _ in range(rng.choice([0, 1, 3, 5, 6, 8, 9, 12, 20, 40, 90, 200]))]
            if kind > 0.85:
                w += passage
        rows.append((len(rows) * 7 % 1009, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(frame, seed):
    rows = near_copies(random.Random(seed), 250)
    got = nj.similar_components(frame(rows).repartition(3))
    assert {tuple(r) for r in got.collect()} == brute(rows)


def kept(rows, percent=80):
    """sig, doc, probe of the rows that ``_candidates`` and ``_peeled`` leave, without Spark."""
    import pyarrow as pa

    texts = pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows], pa.int64()), pa.array([t for _, t in rows])], ["doc", "text"])
    emitted = pa.Table.from_batches(nj._emit(5, percent, 32)(iter([texts]))).sort_by("sig")
    shared = pa.Table.from_batches(nj._shared(iter(emitted.to_batches()))).sort_by("doc")
    left = pa.Table.from_batches(nj._allocate(iter(shared.to_batches())))
    left = left.filter(pa.compute.equal(left["kind"], nj._GROUPED))
    cost = left.group_by("sig").aggregate([("doc", "count")]).rename_columns(["sig", "cost"])
    again = left.join(cost.filter(pa.compute.greater(cost["cost"], 1)), "sig").select(["sig", "doc", "meta", "cost", "kind"])
    if not len(again):
        return []
    again = again.set_column(3, "cost", again["cost"].cast(pa.int64())).sort_by("doc").combine_chunks()
    last = pa.Table.from_batches(nj._allocate(iter(again.to_batches())))
    return list(zip(*(last[c].to_pylist() for c in ("sig", "doc", "probe"))))


def isolated_pair(seed):
    """Two linked texts of 4 to 40 shingles that nothing else resembles: words appended, removed or replaced."""
    rng = random.Random(seed)
    while True:
        a = [f"v{seed}_{i}" for i in range(rng.choice([*range(8, 25), 30, 44]))]
        b = list(a)
        for _ in range(rng.randint(1, 3)):
            i = rng.choice([0, len(b) - 1, len(b)])
            b[i : i + rng.randint(0, 1)] = [f"n{rng.random()}"] * rng.randint(0, 1)
        x, y = sets_of(" ".join(a)), sets_of(" ".join(b))
        if x != y and 100 * len(x & y) >= 80 * len(x | y):
            return [(1, " ".join(a)), (2, " ".join(b))]


def lost(rows):
    """Whether no probed hash is common to the two texts."""
    left = kept(rows)
    docs, probed = {}, set()
    for sig, doc, probe in left:
        docs.setdefault(sig, set()).add(doc)
        if probe:
            probed.add(sig)
    return not any(len(docs[sig]) == 2 for sig in probed)


def test_isolated_pairs_meet():
    assert [seed for seed in range(3000) if lost(isolated_pair(seed))] == []


@pytest.mark.parametrize("seed", [430, 1310])
def test_isolated_pairs_link(frame, seed):
    """Pairs that empty segments kept apart."""
    rows = isolated_pair(seed)
    got = {tuple(r) for r in nj.similar_components(frame(rows)).collect()}
    assert got == brute(rows) and {c for *_, c in got} == {1}


def test_meetings_in_blocks_lose_nothing(frame):
    rows = near_copies(random.Random(5), 150)
    assert {tuple(r) for r in nj.similar_components(frame(rows), block=3, hot=2).collect()} == brute(rows)


def test_hot_hashes_of_a_chunk(frame):
    """A hash that a third of the documents share takes the way of hot hashes."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for d in range(150):
        w = list(base)
        w[rng.randrange(120)] = f"x{d}"
        rows.append((d, " ".join(w)))
    rows += [(1000 + d, " ".join(f"u{d}_{i}" for i in range(50))) for d in range(150)]
    rows += [(2000 + d, "the very same text " * 9) for d in range(40)]
    got = {tuple(r) for r in nj.similar_components(frame(rows).coalesce(1), hot=4).collect()}
    assert got == brute(rows)


def test_edge_cases(frame, spark):
    extra = ", sig string, n_shingles int, component string"
    rows = [
        (1, None, "a", 1, "x"), (2, "", "a", 1, "x"), (3, " \t\n", None, None, None), (4, "one two", "a", 1, "x"),
        (5, "ONE\ttwo", "a", 1, "x"), (6, "x " * 5000, "a", 1, "x"), (7, "X " * 9, "a", 1, "x"), (None, "one two", "a", 1, "x"),
        (8, "É two", "", 0, ""), (9, "é two", "", 0, ""), (4, "one two", "a", 1, "x"),
    ]
    got = sorted(map(tuple, nj.similar_components(frame(rows, extra)).collect()), key=lambda r: (r[0] is None, r))
    assert got == [
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 6), (8, 1, 8), (9, 1, 9), (None, None, None),
    ]
    assert nj.similar_components(frame([])).collect() == []


def test_layout_covers_every_pair():
    """Segments are worth more units than two sets of the band can differ in."""
    for band, start in enumerate(nj.band_starts(100_000)[:-1]):
        m, deletable, largest = nj.band_layout(band)
        assert largest >= start and m + deletable >= nj.differences(largest) + 1
    starts = nj.band_starts(100_000)
    assert all(b * 4 >= a * 5 for a, b in zip(starts[1:], starts[2:]))


def test_small_sets_use_deletions():
    assert nj.band_layout(1)[1] > 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(500, 540), rng.randrange(500, 540)) for _ in range(25)]
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {n: root[n] for n in touched}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingles_are_distinct_per_text():
    h, of = nj.shingles([b"a b c d e f", b"A b c d e", b"", b"z", b"a a a a a a a a"])
    assert np.bincount(of, minlength=5).tolist() == [2, 1, 0, 1, 1]
    assert h[of == 1][0] in h[of == 0]


def test_runs_never_split_a_value():
    import pyarrow as pa

    key = np.sort(np.random.default_rng(1).integers(0, 40, 1000))
    key = np.concatenate([key, np.full(500, 77), [90]])
    batches = [pa.RecordBatch.from_arrays([pa.array(key[i : i + 33]), pa.array(np.arange(len(key))[i : i + 33])], ["k", "i"]) for i in range(0, len(key), 33)]
    parts = list(nj._runs(iter(batches), 0, rows=50))
    assert np.array_equal(np.concatenate([p[0] for p in parts]), key)
    assert np.array_equal(np.concatenate([p[1] for p in parts]), np.arange(len(key)))
    assert len(parts) > 5 and all(a[0][-1] != b[0][0] for a, b in zip(parts, parts[1:]))
    assert list(nj._runs(iter([]), 0)) == []


@pytest.mark.parametrize("rows", [7, 50])
def test_shared_holds_parts_of_a_hot_hash(monkeypatch, rows):
    """Hashes with a third of the rows pass in parts: none of their rows is lost, other hashes stay as they are."""
    import pyarrow as pa

    texts = [(d, f"{'tale ' * (d % 3 == 0)}" + " ".join(f"w{d % 5 and d}_{i}" if i % 40 == 7 else f"b{i}" for i in range(60 if d % 3 else 6))) for d in range(120)]
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in texts], pa.int64()), pa.array([t for _, t in texts])], ["doc", "text"])
    emitted = pa.Table.from_batches(nj._emit(5, 80, 10**6)(iter([batch]))).sort_by("sig")
    batches = emitted.combine_chunks().to_batches(max_chunksize=5)

    def shared():
        table = pa.Table.from_batches(nj._shared(iter(batches)))
        return table, sorted(zip(*(table[c].to_pylist() for c in ("kind", "doc", "meta", "sig")), table["cost"].to_pylist()))

    whole, want = shared()
    runs, sizes = nj._runs, []

    def small(b, column, split=False):
        for part in runs(b, column, rows, split):
            sizes.append(len(part[0]))
            yield part

    monkeypatch.setattr(nj, "_runs", small)
    _, got = shared()
    hot = max(cost for *_, cost in want)
    assert hot > 70 and max(sizes) <= 2 * rows + 10
    grouped = lambda found: [r[:4] for r in found if r[0] == nj._GROUPED]
    assert grouped(got) == grouped(want)
    assert all(1 < r[4] <= w[4] for r, w in zip(got, want) if r[0] == nj._GROUPED)
    same = lambda found: {(r[1], r[2]) for r in found if r[0] == nj._SET}
    assert same(got) == same(want)  # every document, with its size
