"""Plan-shape checks: the properties the scale design relies on."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from strata.plans import queries as Q

OTHERS = set(E.LLM_QUERIES)  # they have tests of their own


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - OTHERS))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _final_plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["c3_match_stateless", "w2_latest_per_key", "c4_best_client",
                                  "t1_top_clients_per_house"])
def test_top_k_is_limited_before_the_shuffle(spark, name):
    plan = _final_plan(getattr(Q, name)(spark, SF_SMALL))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_ingest_parse_has_no_shuffle_after_the_scan(spark):
    from strata.operators import logs
    from strata.session import scratch_path
    from strata.sources import bindings
    path = scratch_path(spark, "t_plan_lines")
    bindings.event_lines(spark, SF_SMALL).write.text(path)
    plan = _final_plan(logs.parse_event_log(spark.read.text(path), Q.RUN_TS))
    assert "Exchange" not in plan and "FileScan text" in plan


def test_matching_scans_are_pruned(spark):
    plan = _final_plan(Q.c3_match_stateless(spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all(len(s.split(",")) <= 5 for s in schemas)
    assert "o_totalprice" not in plan and "p_name" not in plan


def test_date_scan_prunes_partitions(spark):
    plan = _final_plan(Q.s4_date_scan(spark, SF_SMALL))
    assert re.search(r"PartitionFilters: \[[^]]*l_date", plan)


def test_top_clients_need_few_joins(spark):
    plan = _final_plan(Q.t1_top_clients_per_house(spark, SF_SMALL)).split("== Initial Plan ==")[0]
    assert len(re.findall(r"(?:SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)\b", plan)) <= 7
