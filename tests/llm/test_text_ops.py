"""BPE, line dedup, licence scans, quality classifier and top-k search against brute force."""

import base64
import collections
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from stratus.llm import bpe, license_scan, line_dedup, quality, topk_search

ODD = ["", " ", "\n\n", "a" * 3000, " " * 500 + "x", "<|endoftext|> hi", "日本語テキスト🎉🎉", "É é\t\x00 \x85z", "don't we'll I'M"]


# ------------------------------------------------------------------ BPE
@pytest.fixture(scope="module")
def reference():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer(spark):
    return bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def test_perfect_hash_is_minimal_and_tells_strangers(tokenizer):
    table = tokenizer.shared.value
    assert sorted(table.rank_at.tolist()) == list(range(len(table.vocab)))
    assert table.ranks(table.vocab[:2000]) == list(range(2000))
    assert table.ranks([b"\xff\xff\xff", b"qzqzqzqz"]) == [-1, -1]


def test_encodes_like_the_reference_and_back(frame, tokenizer, reference):
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choice("ab cdeé1!\n日'") for _ in range(rng.randint(0, 200))) for _ in range(200)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "null id", "x"), (900, None, None), (3, texts[3], "x")]
    coded = tokenizer.decode(tokenizer.encode(frame(rows, ", ids string"))).collect()
    assert len(coded) == len(rows)
    by_id = {r.doc_id: r for r in coded}
    for i, t, *_ in rows:
        want = reference.encode_ordinary(t or "")
        assert np.frombuffer(by_id[i].ids, "<u4").tolist() == want and by_id[i].n_tokens == len(want)
        assert by_id[i].decoded == (t or "").encode()
    assert tokenizer.encode(frame([])).count() == 0


def test_long_text_in_parts_and_small_memo(monkeypatch, tokenizer, reference):
    monkeypatch.setattr(bpe, "_CHARACTERS", 200)
    monkeypatch.setattr(bpe, "_PIECES", 7)
    monkeypatch.setattr(bpe, "_MEMO", 5)
    codec = bpe.Codec(tokenizer.shared.value, public_tokenizers.PATTERN)
    texts = ["one two three four five six seven eight " * 30, "x", None, "nine ten " * 10]
    for t, ids in zip(texts, codec.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(t or "")
        assert codec.decode(ids) == (t or "").encode()


# ----------------------------------------------------------- line dedup
def words(line):
    return re.findall(rb"[^\x20\x09-\x0D]+", line.encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")))


def distance(a, b):
    """Edit distance by the full table's rows, up to 2: it stops where a row holds nothing smaller."""
    if abs(len(a) - len(b)) > 1:
        return 2
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            prev, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, prev + (x != y))
        if min(d) > 1:
            return 2
    return d[-1]


def brute_lines(rows, least=line_dedup.MIN_NEAR):
    seen, out = [], {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        kept, dropped, n = [], 0, 0
        for line in (t or "").split("\n"):
            w = words(line)
            n += bool(w)
            alike = w and any(w == o or (min(len(w), len(o)) >= least and distance(w, o) <= 1) for o in seen)
            if w:
                seen.append(w)
            if alike:
                dropped += 1
            else:
                kept.append(line)
        out[d] = (n, dropped, None if t is None else "\n".join(kept))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_match_brute_force(frame, seed):
    rng = random.Random(seed)
    pool, rows = [], []
    for d in range(40):
        lines = []
        for _ in range(rng.randint(0, 7)):
            if pool and rng.random() < 0.5:
                w = list(rng.choice(pool))
                if w and rng.random() < 0.6:
                    i = rng.randrange(len(w))
                    w[i : i + 1] = rng.choice([[], ["new"], [w[i], "more"], [w[i].upper()]])
            else:
                w = [rng.choice("abcdefgh") for _ in range(rng.choice([0, 1, 7, 8, 9, 12]))]
            pool.append(w)
            lines.append(rng.choice([" ", "\t", "  "]).join(w))
        rows.append((d * 3 % 40, "\n".join(lines) if d % 11 else None))
    out = line_dedup.drop_lines(frame(rows).repartition(3))
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in out.collect()}
    assert got == brute_lines(rows)


def test_line_edges(frame):
    rows = [(2, "a b\r\nx", "q", 1), (1, "A  b\nx\n\n", "q", 1), (1, "A  b\nx\n\n", "r", 2), (None, "x", None, None), (3, "", "q", 1), (4, None, "q", 1)]
    out = line_dedup.drop_lines(frame(rows, ", n_lines string, gone int"))
    assert out.columns == ["doc_id", "text", "n_lines", "gone", "n_lines_", "n_dropped", "n_near"]
    got = collections.Counter((r.doc_id, r.text, r.n_lines, r.n_lines_, r.n_dropped) for r in out.collect())
    assert got == collections.Counter(
        {(None, "x", None, 1, 0): 1, (1, "A  b\n\n", "q", 2, 1): 1, (1, "A  b\n\n", "r", 2, 1): 1, (2, "", "q", 2, 2): 1, (3, "", "q", 0, 0): 1, (4, None, "q", 0, 0): 1}
    )
    assert line_dedup.drop_lines(frame([])).count() == 0


def test_one_edit():
    rng = random.Random(1)
    for _ in range(3000):
        a = [rng.choice("ab") for _ in range(rng.randint(0, 6))]
        b = [rng.choice("ab") for _ in range(rng.randint(0, 6))]
        assert line_dedup.within_one_edit(a, b) == (distance(a, b) <= 1), (a, b)


# -------------------------------------------------------- licence scans
def scan_brute(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    at = [(i, label) for i in range(len(w)) for p, label in license_scan.BASE.items() if w[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def test_scan_matches_brute_force(frame):
    rng = random.Random(3)
    bits = ["CC", "BY", "cc-by", "general", "Public", "license", "all", "rights", "reserved", "x", "é", "version", "3", "MIT", "\x00", "cc"]
    rows = [(i, rng.choice([" ", "-", ", ", "\n"]).join(rng.choice(bits) for _ in range(rng.randint(0, 40))), 1) for i in range(300)]
    rows += [(1000, None, 1), (1001, "", 1), (None, "cc by", 1), (1002, "General Public License " * 5000, 1), (1, rows[1][1], 1)]
    got = license_scan.scan_licenses(frame(rows, ", score int")).collect()
    assert collections.Counter((r.doc_id, *list(r)[1:6]) for r in got) == collections.Counter((d, *scan_brute(t)) for d, t, _ in rows)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert license_scan.scan_licenses(frame([])).count() == 0


@pytest.mark.parametrize(
    "expression, labels, level",
    [
        ("MIT", {"mit"}, 0.1),
        ("MIT OR GPL-3.0-only", {"mit", "gpl-3.0-only"}, 0.1),
        ("MIT AND GPL-3.0-only", {"mit", "gpl-3.0-only"}, 0.7),
        ("MIT AND GPL-2.0 OR Apache-2.0", {"mit", "gpl-2.0", "apache-2.0"}, 0.1),
        ("MIT AND (GPL-2.0 OR MPL-2.0)", {"mit", "gpl-2.0", "mpl-2.0"}, 0.4),
        ("GPL-2.0 WITH Classpath-exception-2.0", {"gpl-2.0"}, 0.35),
        ("(MIT", {"mit", "broken-expression"}, 0.1),
        ("MIT OR", {"mit", "broken-expression"}, 0.1),
        ("", {"broken-expression"}, 0.5),
        ("MIT Apache-2.0", {"mit", "broken-expression"}, 0.1),
    ],
)
def test_expressions(expression, labels, level):
    named, score = license_scan.evaluate(expression)
    assert named == labels and score == pytest.approx(level)


def test_tags_and_overlapping_phrases():
    automaton = license_scan.Automaton({**license_scan.BASE, **license_scan.NOTICES, license_scan.TAG: None})
    r = license_scan.scan_text(b"// SPDX-License-Identifier: MIT OR (GPL-2.0 AND CC0-1.0)\n GNU General Public License, version 3", automaton)
    assert r[5] == "cc0,cc0-1.0,gpl,gpl-2.0,gpl-3.0,mit" and r[4] == "gpl"
    naive = license_scan.Automaton({"a b": 1, "b a b": 1, "a b a b c": 1})
    text = b"a b a b a b c b a b".split()
    want = {(i, p) for p in ("a b", "b a b", "a b a b c") for i in range(len(text)) if text[i : i + len(p.split())] == p.encode().split()}
    assert set(naive.places(text)) == want


@pytest.mark.parametrize(
    "expression, labels, level",
    [
        ("mitre-1.0", {"unknown:mitre-1.0"}, 0.5),
        ("MIT OR mitre", {"mit", "unknown:mitre"}, 0.1),
        ("GPL-3.0-or-later AND LGPL-2.1+", {"gpl-3.0-or-later", "lgpl-2.1+"}, 0.7),
        ("MIT-only", {"unknown:mit-only"}, 0.5),
        ("LicenseRef-Own", {"licenseref-own"}, 0.5),
        ("GPL-2.0 WITH My-exception", {"gpl-2.0", "unknown:my-exception"}, 0.7),
        ("(bsl-1.0", {"bsl-1.0", "broken-expression"}, 0.1),
    ],
)
def test_identifiers_are_matched_exactly(expression, labels, level):
    named, score = license_scan.evaluate(expression)
    assert named == labels and score == pytest.approx(level)


def test_titles_are_notices(frame):
    """Every title of the list, in a text of its own, gives its identifier; the base columns stay a plain search's."""
    listed = license_scan.titles()
    assert len(listed) > 80 and all(license_scan.known(x) for x in listed)
    rows = [(i, f"Under the {t.upper()}, see below.") for i, t in enumerate(listed.values())]
    for r in license_scan.scan_licenses(frame(rows)).collect():
        name, label = list(listed)[r.doc_id], set(r.labels.split(","))
        assert name in label or len(license_scan.words_of(listed[name].encode())) < 2 or label & set(license_scan.NOTICES.values())
        assert (r.doc_id, *list(r)[1:6]) == (r.doc_id, *scan_brute(rows[r.doc_id][1]))


# ---------------------------------------------------------- classifier
def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality.score_quality(docs, quality.train(docs, labels))
    rows = scored.join(labels, "doc_id").filter(quality.held_out()).collect()
    assert len(rows) > 300 and all((zlib.crc32(str(r.doc_id).encode()) % 5) == 0 for r in rows)
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    lost = sum(r.predicted == 0 and r.quality == 1 for r in rows)
    assert right > 0.98 and lost <= 0.005 * len(rows)


def test_scores_depend_on_texts_only_and_edges(frame, spark):
    rows = [(i, ("good text here, " if i % 2 else "BAD!! TEXT!! ") * 30, "en", 1) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(7, None), (500, 1)], "doc_id long, quality int")
    docs = frame(rows, ", score string, predicted int")
    forest = quality.train(docs, labels)
    other = [(1, None, "x", 0), (None, "", "x", 0), (3, "good text here, " * 30, "zz", 9), (4, "BAD!! TEXT!! " * 30, None, None), (4, "x " * 10**6, "", 0)]
    out = quality.score_quality(frame(other, ", score string, predicted int"), forest, carry=("doc_id", "text", "score"))
    assert out.columns == ["doc_id", "text", "score", "score_", "predicted"]
    got = out.collect()
    assert len(got) == 5 and all(0 <= r.score_ <= 1 and r.predicted == (r.score_ >= 0.3) for r in got)
    assert [r.predicted for r in got[2:4]] == [1, 0] and got[0].score_ == got[1].score_
    none = quality.train(docs.limit(0), labels)
    assert {r.score for r in quality.score_quality(docs.select("doc_id", "text"), none).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), forest).count() == 0


def test_statistics_of_parts_add_up(monkeypatch):
    texts = pa.array(["Ab cd!! 1 | x.", None, "", "same same same\n\nOther", "é ü " * 40])
    whole = quality.features(texts)
    monkeypatch.setattr(quality, "_PART", 16)
    some = quality.features(texts)
    assert np.allclose(whole[:3], some[:3]) and whole.shape == (5, len(quality.NAMES))
    assert whole[3][quality.NAMES.index("echo_words")] == pytest.approx(2 / 4)


# -------------------------------------------------------- top-k search
def test_statistics_are_the_same_at_any_length(monkeypatch):
    rng = random.Random(3)
    words = ["a", "Bc", "Def.", "GHI!", "x|y", "é", "longer-than-a-part-" * 3, "LOUD" * 9, "\x01"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "\n", " \t ", "  "]) for _ in range(n)) for n in (1, 3, 40, 400)]
    texts += ["a " * 300, "W" * 100, " " * 100, "same-and-long-word-of-many " * 5]
    whole = quality.features(pa.array(texts))
    for part in (1, 7, 16, 64):
        monkeypatch.setattr(quality, "_PART", part)
        assert np.array_equal(quality.features(pa.array(texts)), whole)


def brute_topk(rows, k, every, scale):
    ok = [(i, np.floor(scale * np.array(v, float)).astype(object)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, x in ok:
        if q % every == 0:
            best = sorted((-int(sum(a * b for a, b in zip(x, y))), i) for i, y in ok if i != q)[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    return out


def test_topk_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 60)
    monkeypatch.setattr(topk_search, "SAMPLE", 40)
    monkeypatch.setattr(topk_search, "LEAF", 8)
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in centers[i % 6] + 0.1 * rng.normal(size=8)]) for i in range(400)]
    rows += [(400 + i, [1.0] * 8) for i in range(150)]  # one very common vector: ties
    rows += [(600, None), (601, [None] + [1.0] * 7), (602, [float("nan")] * 8), (603, [float("inf")] * 8), (None, [9.0] * 8), (650, [0.0] * 8)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string").repartition(4)
    got = {tuple(r) for r in topk_search.top_k(df, k=5, every=50).collect()}
    assert got == brute_topk(rows, 5, 50, 256.0)


def test_topk_edges(spark):
    kind = "vec_id long, embedding array<float>"
    assert topk_search.top_k(spark.createDataFrame([], kind)).count() == 0
    assert topk_search.top_k(spark.createDataFrame([(50, [1.0])], kind)).count() == 0
    got = topk_search.top_k(spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0]), (2, []), (3, [-1.0, 0.5])], kind)).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1, 65536), (2, 2, 0), (3, 3, 0)]
    big = [(0, [2.0**30, 1.0]), (7, [2.0**30, 3.0]), (8, [2.0**30, 2.0])]
    rows = topk_search.top_k(spark.createDataFrame(big, "vec_id long, embedding array<double>"), scale=1.0).collect()
    assert [(r.vec_id, r.score) for r in sorted(rows, key=lambda r: r["rank"])] == [(7, 2**60 + 3), (8, 2**60 + 2)]


def test_topk_overflow_raises(spark):
    for huge in ([2.0**62], [1e308], [2.0**32, 2.0**32]):
        rows = spark.createDataFrame([(0, huge), (1, huge)], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="does not fit"):
            topk_search.top_k(rows).collect()
    a, b = np.array([[2**33, 2**33, 5], [1, 1, 2]]), np.array([[2**33, -(2**33), 7], [3, 4, 5]])
    assert topk_search.products(a, b).tolist() == [[35, 7 * 2**33 + 25], [14, 17]]  # partial sums wrap, products fit


def test_cover_tree_covers():
    x = np.random.default_rng(2).normal(size=(700, 5))
    seen = []

    def walk(node):
        under = [node.rows] if not node.children else [walk(c) for c in node.children]
        rows = np.concatenate(under)
        assert np.sqrt(((x[rows] - node.center) ** 2).sum(axis=1)).max() <= node.radius + 1e-9
        if not node.children:
            seen.extend(node.rows)
        return rows

    walk(topk_search.cover_tree(x))
    assert sorted(seen) == list(range(700))


def test_held_out_column(spark):
    df = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    got = {r[0]: r[1] for r in df.select("doc_id", quality.held_out().alias("h")).collect()}
    assert got.pop(None) is False and got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(50)}
    assert df.select(F.lit(1)).count() == 51
