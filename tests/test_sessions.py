import random

import pytest
from conftest import T, role_df
from pyspark.sql import Window
from pyspark.sql import functions as F

from opsmetrics.functions.windows import ReportWindow
from opsmetrics.operators.sessions import (
    hourly_time,
    previous_in_order,
    session_changes,
    working_time,
)

DAY = "2024-01-08 "
W = ReportWindow.of(DAY + "09:00:00", DAY + "11:59:59")  # L = 10,799 s
X, Y = "wave_picking", "qc_shipping"  # Picking, QC

LOG = [
    ("a", "in", "09:10", X), ("a", "in", "09:12", X), ("a", "out", "09:40", X), ("a", "out", "09:45", X),
    ("a", "in", "10:50", X), ("a", "out", "11:05", X),
    ("b", "in", "11:30", X),
    ("c", "out", "09:30", X), ("c", "in", "11:00", X),
    ("d", "in", "09:20", X), ("d", "in", "09:40", Y), ("d", "out", "09:50", Y),
]


@pytest.fixture
def worklog(spark):
    rows = [dict(warehouse="whracks10", logid=i + 1, emailaddress=w, status=s, actiontime=T(DAY + t), modulename=m)
            for i, (w, s, t, m) in enumerate(LOG)]
    return role_df(spark, "worklog", rows)


@pytest.mark.parametrize("block", [1 << 20, 1, 2, 3])
def test_report_seconds(worklog, block):
    ch = session_changes(worklog, [X], W, block=block)
    t = {r.emailaddress: r.total_working_seconds for r in working_time(ch, W).collect()}
    assert t == {"a": 2700.0, "b": None, "c": 5399.0, "d": None}
    ch = session_changes(worklog, [Y], W, block=block)
    assert {r.emailaddress: r.total_working_seconds for r in working_time(ch, W).collect()} == {"d": 600.0}


def test_report_interval(worklog):
    ch = session_changes(worklog, [X], W)
    t = {r.emailaddress: r.total_working_hrs for r in working_time(ch, W).collect()}
    assert t["a"].total_seconds() == 2700 and t["c"].total_seconds() == 5399 and t["b"] is None


def test_kept_rows(worklog):
    ch = session_changes(worklog, [X], W)
    a = sorted((r.actiontime.strftime("%H:%M"), r.status) for r in ch.where(F.col("emailaddress") == "a").collect())
    assert a == [("09:10", "in"), ("09:40", "out"), ("10:50", "in"), ("11:05", "out")]


@pytest.mark.parametrize("block", [1 << 20, 2])
def test_hourly_seconds(worklog, block):
    got = {(r.emailaddress, r.process, r.timestamp.hour): r.working_sec for r in hourly_time(worklog, W, block).collect()}
    assert got == {
        ("a", "Picking", 9): 1800.0, ("a", "Picking", 10): 600.0, ("a", "Picking", 11): 300.0,
        ("b", "Picking", 11): 1800.0,
        ("c", "Picking", 9): 1800.0, ("c", "Picking", 11): 0.0,
        ("d", "Picking", 9): 2400.0, ("d", "QC", 9): 3000.0,
    }


def test_previous_in_order_matches_lag(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(600):
        k = rnd.choice(["p", "q", None, "hot", "hot", "hot"])
        logid = rnd.choice([None] + [i] * 30) if i % 97 == 0 else i
        rows.append((k, "w1" if i % 5 else None, logid, rnd.choice(["in", "out", None])))
    df = spark.createDataFrame(rows, "k string, g string, logid bigint, status string").withColumn("rid", F.monotonically_increasing_id())
    # unique order so both sides agree on ties
    df = df.where(F.col("logid").isNotNull() | (F.col("rid") % 1 == 0))
    w = Window.partitionBy("k", "g").orderBy(F.col("logid").asc_nulls_last())
    base = df.where(F.col("logid").isNotNull())
    ref = {r.rid: r.prev for r in base.withColumn("prev", F.lag("status").over(w)).collect()}
    for block in (1, 7, 64, 1 << 20):
        got = {r.rid: r.prev for r in previous_in_order(base, ["k", "g"], "logid", "status", "prev", block).collect()}
        assert got == ref, block


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_previous_in_order_levels_with_sparse_ids(spark, levels):
    rnd = random.Random(11)
    rows = [(rnd.choice(["hot", "hot", "x", None]), rnd.randrange(1 << 40), rnd.choice(["in", "out"])) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, logid bigint, status string").dropDuplicates(["logid"])
    w = Window.partitionBy("k").orderBy("logid")
    ref = {r.logid: r.prev for r in df.withColumn("prev", F.lag("status").over(w)).collect()}
    for block in (2, 16, 1 << 20):
        got = {r.logid: r.prev for r in previous_in_order(df, ["k"], "logid", "status", "prev", block, levels).collect()}
        assert got == ref, (block, levels)


def test_rows_without_an_order_value_come_last_once_each(spark):
    rows = [("k", i if i < 20 else None, f"s{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "k string, logid bigint, status string")
    for block in (3, 1 << 20):
        got = previous_in_order(df, ["k"], "logid", "status", "prev", block).collect()
        follows = {r.prev: r.status for r in got}
        seen, at = [], None
        while at in follows:
            at = follows[at]
            seen.append(at)
        assert seen[:20] == [f"s{i}" for i in range(20)] and sorted(seen) == sorted(f"s{i}" for i in range(60))
