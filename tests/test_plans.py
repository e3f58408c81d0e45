"""Plan shape of every batch query: no cartesian products or nested-loop joins
(every join is an equi-join, interval joins included), and scans read only
the needed columns."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
STREAMING = {"src_file_stream", "late_drop", "sink_jsonl_roundtrip", "sink_dynamic_topic"}
KEYS = sorted(k for k in E.queries() if k not in STREAMING and not k.endswith("_stream"))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_no_cartesian_or_nested_loop(spark, key):
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # the static plan, before runtime rewrites
    try:
        plan = _plan(E.queries()[key](spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_columns(spark):
    plan = _plan(E.queries()["dwd_order_refund"](spark, SF))
    lineitem_scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "l_orderkey" in ln][0]
    assert "l_tax" not in lineitem_scan and "l_discount" not in lineitem_scan
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in lineitem_scan


def test_topic_union_is_pruned(spark):
    plan = _plan(E.queries()["dwd_cart_add"](spark, SF))
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    assert len(scans) == 1 and "events" in scans[0]
