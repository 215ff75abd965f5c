"""Every stage of the pipeline against a plain Python version on its own input."""

import collections
import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as cp
from stratus.llm import bpe
from tests.llm.test_native_ops import targets as mix_targets
from tests.llm.test_ngram_join import brute as brute_components
from tests.llm.test_text_ops import brute_lines

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage, each written and read again."""
    from stratus.llm.common import written

    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        out = written(stage(spark, docs, SF), f"test-{name}")
        seen[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in out.collect()], out.columns)
        docs = out
    return seen


def test_stages_in_order(stages):
    assert [n for n, _ in cp.STAGES] == ["quality", "line_dedup", "near_duplicates", "mix", "encode"]
    for name in ("quality", "line_dedup", "near_duplicates", "mix"):
        assert stages[name][2] == ["doc_id", "text", "lang", "source", "n_chars"]
        assert all(r["n_chars"] == len(r["text"]) for r in stages[name][1])


def test_quality_keeps_the_good(spark, stages):
    before, after, _ = stages["quality"]
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after}
    good = [r["doc_id"] for r in before if label.get(r["doc_id"]) == 1]
    bad = [r["doc_id"] for r in before if label.get(r["doc_id"]) == 0]
    assert sum(d in kept for d in good) >= 0.98 * len(good) and sum(d in kept for d in bad) <= 0.3 * len(bad)
    assert {r["doc_id"]: r["text"] for r in after}.items() <= {r["doc_id"]: r["text"] for r in before}.items()


def test_lines(stages):
    before, after, _ = stages["line_dedup"]
    want = brute_lines([(r["doc_id"], r["text"]) for r in before])
    want = {d: t for d, (n, gone, t) in want.items() if n == 0 or gone < n}
    assert {r["doc_id"]: r["text"] for r in after} == want


def test_one_of_each_group(stages):
    before, after, _ = stages["near_duplicates"]
    groups = brute_components([(r["doc_id"], r["text"]) for r in before])
    assert {r["doc_id"] for r in after} == {d for d, _, c in groups if d == c}


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_mix(stages):
    before, after, _ = stages["mix"]
    size, longest, taken = collections.Counter(), collections.Counter(), collections.Counter()
    row = {r["doc_id"]: r for r in before}
    for r in before:
        size[r["source"]] += n_words(r["text"])
        longest[r["source"]] = max(longest[r["source"]], n_words(r["text"]))
    times = collections.Counter()
    for r in after:
        assert r == row[r["doc_id"]]  # whole documents
        taken[r["source"]] += n_words(r["text"])
        times[r["doc_id"]] += 1
    assert max(times.values()) <= 2 and all(times[r["doc_id"]] == 1 for r in before if not n_words(r["text"]))
    want = mix_targets(size)
    assert all(abs(taken[s] - want[s]) <= longest[s] / 2 + 1 for s in size)


def test_encoding(stages):
    before, after, _ = stages["encode"]
    vocab = bpe.read_ranks(public_tokenizers.path(cp.VOCABULARY))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={p: i for i, p in enumerate(vocab)}, special_tokens={})
    want = collections.Counter((r["doc_id"], np.array(enc.encode_ordinary(r["text"]), "<u4").tobytes(), hashlib.sha256(r["text"].encode()).hexdigest()) for r in before)
    assert collections.Counter((r["doc_id"], r["ids"], r["decoded_sha256"]) for r in after) == want
    assert all(4 * r["n_tokens"] == len(r["ids"]) for r in after)


def test_run_applies_all_stages(spark, stages):
    rows = cp.run(spark, SF).collect()
    key = lambda r: (r["doc_id"], r["n_tokens"], r["decoded_sha256"])
    assert collections.Counter(map(key, rows)) == collections.Counter(map(key, stages["encode"][1]))


CLASHES = {c: "x" for c in ("n_lines", "n_dropped", "n_near", "text_hash", "pass", "slot", "component_id", "ids", "decoded")} | {
    c: 0 for c in ("predicted", "score", "size", "upto", "start", "times")
}


def test_stages_keep_extra_columns_of_any_name(spark):
    """Columns named like the ones that operators add change no stage's rows, and come back as they were."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 60")
    extra = {c: F.lit(v) for c, v in CLASHES.items()}
    for name, stage in cp.STAGES:
        plain = stage(spark, docs, SF).collect()
        wide = stage(spark, docs.withColumns(extra), SF)
        if name != "encode":
            assert wide.columns == docs.columns + list(CLASHES)
        rows = wide.collect()
        key = lambda r: (r["doc_id"], r["text"]) if name != "encode" else (r["doc_id"], r["ids"], r["decoded_sha256"])
        assert collections.Counter(map(key, rows)) == collections.Counter(map(key, plain)) and len(plain) > 10
        if name != "encode":
            assert all(r[c] == v for r in rows for c, v in CLASHES.items())


EDGES = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, " \n\t", "en", "s", 3), (None, "one two three", "en", None, 13)]


@pytest.mark.parametrize("rows", [[], EDGES])
def test_stages_take_empty_and_null_rows(spark, rows):
    """Blank texts pass every stage as they are; a table without rows stays empty."""
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    given = collections.Counter(map(str, docs.collect()))
    assert collections.Counter(map(str, cp.keep_quality(spark, docs, SF).collect())) <= given
    for name, stage in cp.STAGES[1:3]:
        assert collections.Counter((r.doc_id, r.text) for r in stage(spark, docs, SF).collect()) == collections.Counter(r[:2] for r in rows)
    mixed = collections.Counter(map(str, cp.mix(spark, docs, SF).collect()))
    words = str(docs.filter("text = 'one two three'").first())
    assert {k: n for k, n in mixed.items() if k != words} == {k: n for k, n in given.items() if k != words}
    assert mixed[words] == (2 if rows else 0)  # 1.5 times its words, rounded to whole documents
    coded = cp.encode(spark, docs, SF).collect()
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert collections.Counter((r.doc_id, r.decoded_sha256) for r in coded) == collections.Counter((d, sha(t)) for d, t, *_ in rows)
    assert all(r.n_tokens == len(r.ids) // 4 for r in coded)
