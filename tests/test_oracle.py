"""Every registered query against its DuckDB oracle (small scale factor)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from stratus.plans import queries as base
from tools.check_oracle import TABLES, digest
from tools.check_types import duck_types, spark_types

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_contract(spark):
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert set(base.QUERIES) == set(base.ORACLE) and set(base.QUERIES) <= set(qs)
    df = E.entry(spark)
    assert df.columns == ["COUNTRY_CODE", "YEAR", "AVERAGE", "COUNTRY_NAME"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(base.ORACLE))
def test_query_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF)
    assert spark_types(sdf) == duck_types(duck, E.oracle_sql()[key])
    spdf = sdf.toPandas()
    opdf = duck.execute(E.oracle_sql()[key]).df()
    assert sorted(spdf.columns) == sorted(opdf.columns)
    assert len(spdf) == len(opdf)
    assert digest(spdf) == digest(opdf)


def test_rows_only_keys(spark):
    rec = E.queries()["sink_reconcile"](spark, SF).first()
    assert rec.ok and rec.source_rows == 25


@pytest.mark.parametrize(
    "key", ["enrich_stations", "rainfall_country_year", "geo_country_pairs", "geo_closest_pair", "join_left_anti"]
)
def test_without_broadcasts(spark, duck, key):
    """Beyond the broadcast bound the same plans run as shuffle joins."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        sdf = E.queries()[key](spark, SF)
        plan = sdf._jdf.queryExecution().executedPlan().toString()
        spdf = sdf.toPandas()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "BroadcastHashJoin" not in plan
    opdf = duck.execute(E.oracle_sql()[key]).df()
    assert len(spdf) == len(opdf) and digest(spdf) == digest(opdf)
