"""The registered queries: SQL oracles, columns, and independence of partitions."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from stratus.llm import queries as q
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_ngram_join": ["doc_id", "n_shingles", "component_id"],
    "op2_mix_sources": ["doc_id", "size", "source_size", "target", "taken"],
    "op3_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op4_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op5_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op7_topk_search": ["query_id", "rank", "vec_id", "score"],
    "op9_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op10_quality": ["doc_id", "held_out", "score", "predicted"],
    "op11_hard_negatives": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
    "op12_periodic_runs": [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ],
    "op13_sentencepiece": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_one_query_per_operator():
    names = list(E.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(q.ORACLE) <= set(names)


@pytest.mark.parametrize("key", sorted(COLUMNS))
def test_contract_columns(spark, key):
    df = E.queries()[key](spark, SF)
    assert df.columns[: len(COLUMNS[key])] == COLUMNS[key]
    if "doc_id" in df.columns:
        assert df.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


@pytest.mark.parametrize("key", sorted(q.ORACLE))
def test_matches_sql(spark, duck, key):
    got = E.queries()[key](spark, SF).toPandas()
    want = duck.execute(q.ORACLE[key]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    assert digest(got) == digest(want)


@pytest.mark.parametrize("key", ["op3_exact_dedup", "op5_sharding", "op8_url_filter"])
def test_native_plans_hold_no_python(spark, key):
    plan = E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "MapInArrow", "Cartesian", "BroadcastNestedLoop"))
