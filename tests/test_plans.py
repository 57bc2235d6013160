"""Plan-shape tests: the physical operators the design relies on are really there."""

import re

import pytest

import __spark_entry__ as E
from strata.plans.explain import plan_text

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def q():
    return E.queries()


def test_latest_per_key_limits_before_shuffle(spark, q):
    plan = plan_text(q["latest_per_key_first"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan
    # the partial limit sits below the exchange
    assert plan.index("Partial") > plan.index("Exchange")


def test_dedupe_limits_before_shuffle(spark, q):
    plan = plan_text(q["dedupe_composite_key"](spark, SF))
    assert re.search(r"WindowGroupLimit.*Partial", plan, re.S)


def test_top_k_is_take_ordered(spark, q):
    assert "TakeOrderedAndProject" in plan_text(q["top_k_rows"](spark, SF))


def test_partition_pruning(spark, q):
    plan = plan_text(q["partitioned_scan"](spark, SF))
    assert re.search(r"PartitionFilters: \[.*o_year.* = 1997\)", plan)


def test_lookup_broadcast(spark, q):
    assert plan_text(q["join_lookup"](spark, SF)).count("BroadcastHashJoin") >= 2


def test_band_query_prunes_and_pushes(spark, q):
    plan = plan_text(q["agg_by_band"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<(.*)>", plan)
    assert {frozenset(x.split(",")) for x in schemas} == {
        frozenset(["l_partkey:bigint", "l_extendedprice:double", "l_quantity:double"]),
        frozenset(["p_partkey:bigint", "p_size:int"])}
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(p_size,16\).*LessThanOrEqual\(p_size,40\)",
                     plan)


def test_fact_aggregates_are_two_phase(spark, q):
    plan = plan_text(q["activity_stats"](spark, SF))
    assert "partial_sum" in plan and "partial_count" in plan


def test_no_python_udf_in_queries(spark, q):
    for name in ("value_fact", "constraint_report", "cast_numeric", "top_groups_formatted"):
        plan = plan_text(q[name](spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
