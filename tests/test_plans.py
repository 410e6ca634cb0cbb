"""Plan shape checks: pruning and pushdown reach the scans, no Python in the plans."""

import os

import pytest

import __spark_entry__ as se
from opsmetrics import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def plan(df) -> str:
    """The formatted explain text (scan details are not truncated there)."""
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_report_scans_are_pruned_and_filtered(spark):
    p = plan(se.queries()["report_picking"](spark, SF))
    pruned = [x for x in p.splitlines() if x.startswith("PartitionFilters:")]
    assert any("isnotnull(item_table" in x and "= pick)" in x for x in pruned)
    assert "= Picking)" in p
    assert "GreaterThan(lastmodifieddate" in p and "LessThan(lastmodifieddate" in p
    assert "In(modulename" in p and "In(status" in p


def test_hourly_feed_reads_items_once(spark):
    p = plan(se.queries()["pick_detail"](spark, SF))
    assert sum(1 for line in p.splitlines() if line.startswith("Location:") and line.rstrip().endswith("/items]")) == 1


# The optional subpackage may run numpy inside tasks.
@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_no_python_in_plans(spark, key):
    if key in ("incremental_run", "stream_hourly_items", "sink_csv", "sink_append", "sink_report_files"):
        pytest.skip("writes data")
    p = plan(se.queries()[key](spark, SF))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert marker not in p, (key, marker)


def test_blocked_lag_shuffles_the_log_once(spark):
    p = plan(se.queries()["session_dedup"](spark, SF))
    scans = [x for x in p.splitlines() if x.startswith("Location:")]
    initial = p.split("== Initial Plan ==")[-1].split("(1)")[0]
    assert "SortAggregate" not in p and "Join" not in initial
    df = se.queries()["session_dedup"](spark, SF)
    df.collect()
    tree = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert tree.count("FileScan") == 1, tree  # every other branch reuses the exchange
    assert scans


@pytest.mark.parametrize("key", ["report_picking", "report_qc_v2", "pick_detail", "hourly_time", "grc_report", "param_report"])
def test_windows_become_day_partition_filters(spark, key):
    p = plan(se.queries()[key](spark, SF))
    days = [x for x in p.splitlines() if x.startswith("PartitionFilters:") and "(stamp_day" in x and ">= 2024-01-01" in x and "<= 2024-01-31" in x]
    assert days, p
