"""Plan shapes that matter at scale: no per-key window without the block
column, routing joins broadcast, top-n per queue by blocks,
no cartesian products, scans pruned to the columns used."""

import re

import pytest

from sluice.plans import catalogue as entry
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = [n for n in entry.queries() if not n.startswith("stream_")]


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_no_unpartitioned_window(spark, name):
    p = plan(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert not re.search(r"Window \[.*?\], \[\], \[", p), "window without partition keys"


@pytest.mark.parametrize("name", ["running_latency", "fetch_slice", "put_capacity", "route_asof"])
def test_ordered_state_windows_are_blocked(spark, name):
    p = plan(entry.queries()[name](spark, SF_SMALL))
    windows = [w for w in re.findall(r"Window \[.*?\], \[(.*?)\], \[", p)]
    assert windows
    for keys in windows:
        # either the in-block window (key, block) or the small per-key totals window
        assert "_scan_blk" in keys or "_scan_k0" in keys or "_l_b" in keys or "_l_k" in keys, keys


def test_routing_is_broadcast(spark):
    p = plan(entry.queries()["route_two_hop"](spark, SF_SMALL))
    assert p.count("BroadcastHashJoin") >= 2
    assert "SortMergeJoin" not in p


@pytest.mark.parametrize("name", ["queue_get", "queue_get_state"])
def test_queue_get_sorts_no_whole_queue(spark, name):
    p = plan(entry.queries()[name](spark, SF_SMALL))
    keys = re.findall(r"Window \[.*?\], \[(.*?)\], \[", p)
    assert keys and all("_scan_blk" in k or "_scan_k0" in k for k in keys)


def test_running_latency_takes_no_checkpoint(spark):
    assert "ExistingRDD" not in plan(entry.queries()["running_latency"](spark, SF_SMALL))


def test_scan_prunes_columns(spark):
    p = plan(entry.queries()["running_latency"](spark, SF_SMALL))
    for schema in re.findall(r"ReadSchema: struct<(.*?)>", p):
        assert "props" not in schema and "event_type" not in schema
