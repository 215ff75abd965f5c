"""op11: hard negatives from R-trees against a plain search."""

import numpy as np
import pyarrow as pa
import pytest

from stratus.llm import hard_negatives as hn


def brute(rows, k=5, positives=5, every=100, window=(80, 100)):
    """The contract, row by row; ``rows`` are (id, label, whole numbers)."""
    out = []
    for a, label, v in rows:
        if a % every:
            continue
        scored = sorted(((-int(v @ w), i, other) for i, other, w in rows if i != a))
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [(n, i) for n, i, other in scored if other != label and window[0] * -s <= 100 * -n <= window[1] * -s]
            out += [(a, p, r, i, -s, -n) for r, (n, i) in enumerate(fits[:k], 1)]
    return sorted(out)


def clustered(rng, n, width=8, centers=40):
    c = rng.normal(size=(centers, width)) * 40
    return np.rint(c[rng.integers(0, centers, n)] + rng.normal(size=(n, width))).astype(np.int64)


def mined(df, **how):
    return sorted(tuple(r) for r in hn.mine_negatives(df, scale=1.0, **how).collect())


def frame(spark, rows):
    return spark.createDataFrame([(int(i), [float(x) for x in v], int(lab)) for i, lab, v in rows], "vec_id long, embedding array<double>, label int")


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(hn, "BLOCK", 150)
    monkeypatch.setattr(hn, "GROUP", 7)
    monkeypatch.setattr(hn, "LEAF", 8)


@pytest.mark.parametrize("kind", ["clusters", "noise", "ties"])
def test_equals_brute_force(spark, small_blocks, kind):
    rng = np.random.default_rng(len(kind))
    x = {
        "clusters": lambda: clustered(rng, 1200),
        "noise": lambda: rng.integers(-99, 100, (1200, 12)),
        "ties": lambda: rng.integers(-1, 2, (1200, 3)),
    }[kind]()
    rows = [(i, int(rng.integers(0, 4)), x[i]) for i in range(1200)]
    assert mined(frame(spark, rows), every=50) == brute(rows, every=50)


def test_one_vector_and_one_label_hold_a_third(spark, small_blocks):
    rng = np.random.default_rng(2)
    x = clustered(rng, 900)
    x[rng.permutation(900)[:300]] = 17
    rows = [(i, 0 if i % 3 else int(rng.integers(0, 3)), x[i]) for i in range(900)]
    assert mined(frame(spark, rows), every=30) == brute(rows, every=30)


def test_tree_prunes_where_the_vectors_have_structure():
    """The share of rows that searches look at: small for clusters, all of it for directions without structure."""
    rng = np.random.default_rng(4)
    share = {}
    for kind, x in (("clusters", clustered(rng, 4000)), ("noise", np.rint(rng.normal(size=(4000, 64)) * 32).astype(np.int64))):
        tree = hn.RTree(x, np.arange(4000), rng.integers(0, 10, 4000))
        anchors = x[:40]
        reach, scores = tree.intervals(anchors), hn._scores(anchors, tree)
        label = dict(zip(tree.ids.tolist(), tree.labels.tolist()))
        for i in range(40):
            tree.search(i, reach, scores, i, label[i], True, 5, [hn._EVERY])
        share[kind] = tree.seen / (40 * 4000)
    assert share["clusters"] < 0.25 and share["noise"] > 0.9


def test_boxes_hold_their_rows_and_windows_their_scores():
    rng = np.random.default_rng(6)
    x = rng.integers(-50, 50, (700, 5))
    tree = hn.RTree(x, np.arange(700), np.zeros(700, np.int64))
    assert sorted(tree.ids.tolist()) == list(range(700)) and (tree.ends - tree.starts).max() <= hn.LEAF
    low, high = tree.intervals(x[:9])[0]
    for n, (a, b) in enumerate(zip(tree.starts, tree.ends)):
        s = x[:9] @ tree.x[a:b].T
        assert (s.min(axis=1) >= low[:, n]).all() and (s.max(axis=1) <= high[:, n]).all()
    for score in range(-30, 31):
        lo, hi = hn.score_window(score, 80, 100)
        assert [s for s in range(-99, 99) if 80 * score <= 100 * s <= 100 * score] == list(range(lo, hi + 1))


def test_tiles_follow_the_cuts():
    rng = np.random.default_rng(8)
    x = rng.integers(0, 1000, (4000, 6))
    cuts = hn.tile_cuts(x, 16)
    sizes = np.bincount(hn.tiles_of(x, cuts))
    assert 16 <= len(sizes) <= 32 and sizes.min() > 0 and sizes.max() < 4000 / 16 * 1.5


def test_edges(spark, small_blocks):
    """Nulls anywhere, non-finite and unequal vectors, repeated ids, clashing columns, an empty table, large numbers."""
    rows = [
        (0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 1.9], 2), (2, [1.0, 1.9], 2), (3, None, 1), (None, [1.0, 2.0], 1),
        (4, [1.0, None], 2), (5, [float("nan"), 1.0], 2), (6, [1.0, 2.0], None), (7, [1.0], 2), (8, [0.9, 2.0, 5.0], 3), (9, [], 4),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns(
        {"tile": hn.F.lit(1), "score": hn.F.lit("x"), "v": hn.F.lit(0)}
    )
    got = sorted(tuple(r) for r in hn.mine_negatives(df, scale=10.0, every=100).collect())
    # 500 of the positive; 100 + 380 twice, 90 + 400
    assert got == [(0, 1, 1, 8, 500, 490), (0, 1, 2, 2, 500, 480), (0, 1, 3, 2, 500, 480)]
    assert hn.mine_negatives(df.limit(0)).collect() == []
    big = [(0, [2.0**30, 1.0], 1), (1, [2.0**30, 1.0], 1), (2, [2.0**30, 0.0], 2)]
    out = hn.mine_negatives(spark.createDataFrame(big, "vec_id long, embedding array<double>, label int"), scale=1.0).collect()
    assert [tuple(r) for r in out] == [(0, 1, 1, 2, 2**60 + 1, 2**60)]
    with pytest.raises(OverflowError):
        hn.products(np.array([[2**61]]), np.array([[2**61]]))
    assert hn.integer_vectors(pa.array([[0.5], None]), 256.0)[1] is None
