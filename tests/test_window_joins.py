"""Joins against a table of windows never collect the side that grows with the data."""

import datetime as dt

import pytest

from conftest import T, role_df
from opsmetrics.operators import intervals


@pytest.fixture
def tables(spark, tmp_path):
    rows = [dict(tier="live", warehouse="w", taskid=i, tasktype="Packing", startdate=T("2024-01-01 00:00") + dt.timedelta(days=i % 9),
                 enddate=None if i % 7 == 0 else T("2024-01-03 12:00") + dt.timedelta(days=i % 20)) for i in range(200)]
    role_df(spark, "tasks", rows).write.parquet(str(tmp_path / "tasks"))
    windows = [(T("2024-01-01 00:00") + dt.timedelta(hours=h), T("2024-01-01 00:00") + dt.timedelta(hours=h + 30)) for h in range(0, 300, 12)]
    return spark.read.parquet(str(tmp_path / "tasks")), spark.createDataFrame(windows, "window_start timestamp_ntz, window_end timestamp_ntz")


def _plan_and_rows(df):
    rows = sorted(map(repr, df.collect()))
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0], rows


def test_stored_tasks_are_not_broadcast(tables, monkeypatch):
    tasks, windows = tables
    plan, rows = _plan_and_rows(intervals.overlapping_windows(tasks, windows))
    assert "BroadcastHashJoin" in plan and "BuildLeft" not in plan, plan
    monkeypatch.setattr(intervals, "SMALL", 0)  # a large table of windows
    plan, merged = _plan_and_rows(intervals.overlapping_windows(tasks, windows))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, plan
    assert rows and merged == rows


def test_stored_stamps_are_not_broadcast(tables):
    tasks, windows = tables
    plan, rows = _plan_and_rows(intervals.stamps_in_windows(tasks, "startdate", windows))
    assert "BroadcastHashJoin" in plan and "BuildLeft" not in plan, plan
    assert rows
