"""Plan-shape guards for every registered query (planned, not executed)."""

import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["BroadcastNestedLoopJoin", "CartesianProduct"]
# Windows without a partition key are allowed only over bounded inputs:
# per-partition offsets of dense ids, the validation log, the reassignment bins.
BOUNDED_GLOBAL_WINDOWS = {
    # dense ids: cumulative offsets over one row per partition
    "surrogate_key", "ticket_transform", "default_columns", "load_fact_ticket", "load_fact_metrics",
    "stage_support", "profile_describe",
    # one row per check / per reassignment bin
    "validation_log", "dq_score", "reassign_step"}


# A window spec whose first argument is an ordering or the frame has no partition key.
UNPARTITIONED = re.compile(r"windowspecdefinition\((specifiedwindowframe|[^,()]* (ASC|DESC))")


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(entry.queries()))
def test_no_nested_loop_or_cartesian(spark, key):
    plan = planned(entry.queries()[key](spark, SF))
    for node in FORBIDDEN:
        assert node not in plan, f"{key}: {node}"
    if key not in BOUNDED_GLOBAL_WINDOWS:
        assert not UNPARTITIONED.search(plan), f"{key}: window without partition"


def test_scan_reads_only_needed_columns(spark):
    plan = planned(entry.queries()["ticket_kpis"](spark, SF))
    orders = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "o_orderkey" in s]
    assert orders and all("o_totalprice" not in s for s in orders)


def test_unpartitioned_window_is_detected(spark):
    for key in ["surrogate_key", "reassign_step"]:
        assert UNPARTITIONED.search(planned(entry.queries()[key](spark, SF)))
    assert not UNPARTITIONED.search(planned(entry.queries()["customer_health"](spark, SF)))
