"""Physical-plan properties every registered query must keep."""

import re

import pytest

import __spark_entry__ as E
from stratus.plans import queries as base

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("key", sorted(base.QUERIES))
def test_no_cartesian_or_python(spark, key):
    text = plan_text(E.queries()[key](spark, SF))
    bad = [f for f in FORBIDDEN if f in text]
    assert not bad, f"{key}: {bad}"


def test_lake_prunes_partitions_and_pushes_filters(spark):
    df = E.queries()["lake_rainfall_one_year"](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(YEAR" in text and "= 2000)" in text
    assert "EqualTo(ELEMENT,PRCP)" in text


def test_pruned_read_schema(spark):
    df = E.queries()["core_element_counts"](spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    # events is read with only the columns the query needs
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in text  # ts, value, props pruned


def final_plan(df) -> str:
    df.collect()  # run this DataFrame's own execution: the adaptive plan is final
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return re.sub(r"#\d+L?", "", text)  # drop expression ids


def test_rainfall_aggregates_before_shuffle_and_names_after(spark):
    lines = final_plan(E.queries()["rainfall_country_year"](spark, SF)).splitlines()
    idx = lambda pat: next(i for i, l in enumerate(lines) if pat in l)
    name_join = idx("LeftOuter")
    final_agg = idx("HashAggregate(keys=[COUNTRY_CODE")
    partial = idx("partial_avg")
    shuffle = idx("Exchange hashpartitioning(COUNTRY_CODE")
    # top-down: names joined above the final aggregate; partial avg below the shuffle
    assert name_join < final_agg < shuffle < partial


def test_tmin_without_tmax_single_shuffle(spark):
    plan = final_plan(E.queries()["tmin_without_tmax"](spark, SF))
    shuffles = [l for l in plan.splitlines() if "Exchange hashpartitioning" in l and "Reused" not in l]
    assert len(shuffles) == 1 and "hashpartitioning(ID" in shuffles[0] and "DATE" in shuffles[0]


def test_enrich_broadcasts_dimensions(spark):
    plan = final_plan(E.queries()["enrich_stations"](spark, SF))
    assert "BroadcastHashJoin [COUNTRY_CODE]" in plan and "BroadcastHashJoin [STATE]" in plan


def test_element_counts_partial_before_shuffle(spark):
    lines = final_plan(E.queries()["core_element_counts"](spark, SF)).splitlines()
    shuffle = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning(ELEMENT" in l)
    partial = next(i for i, l in enumerate(lines) if "partial_count" in l)
    assert shuffle < partial


def shuffles(plan: str) -> list[str]:
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]


@pytest.mark.parametrize("key", ["station_element_count", "agg_having"])
def test_distinct_elements_take_one_shuffle_on_the_station(spark, key):
    plan = final_plan(E.queries()[key](spark, SF))
    assert "count(distinct" not in plan
    assert sum("hashpartitioning(ID" in line for line in shuffles(plan)) <= 1


def test_count_check_aggregates_before_the_join(spark):
    lines = final_plan(E.queries()["join_left_count_check"](spark, SF)).splitlines()
    join = next(i for i, line in enumerate(lines) if "LeftOuter" in line)
    assert any("partial_count(1)" in line for line in lines[join:])


def test_one_year_is_a_range_the_scan_can_take(spark):
    text = E.queries()["rainfall_country_one_year"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in text.splitlines() if "PushedFilters" in line and "l_shipdate" in line]
    assert pushed and "GreaterThanOrEqual(l_shipdate" in pushed[0] and "LessThan" in pushed[0]
