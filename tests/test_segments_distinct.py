import datetime as dt
import os
import random
import uuid

from conftest import T, make_roles, role_df
from pyspark.sql import functions as F
from test_incremental import DAY, item, roles

from opsmetrics.functions.windows import ReportWindow
from opsmetrics.operators import segments as sg
from opsmetrics.operators.sessions import session_changes, working_time
from opsmetrics.plans import distinct, late_hours
from opsmetrics.plans.hourly import hourly_pipeline, hourly_report
from opsmetrics.session import checkpoint_dir
from opsmetrics.sources.snapshots import Snapshots
from opsmetrics.streaming import hourly_users

MODULES = ["wave_picking", "bin_packing"]


def _log(seed, n=300, days=6):
    """Ids rise with the days, but for worker m, whose ids do not, and worker u, some of whose ids are unknown."""
    rnd = random.Random(seed)
    at = sorted(rnd.randrange(days * 86400) for _ in range(n))
    rows = []
    for i, sec in enumerate(at):
        w = rnd.choice(["a", "b", "c", "m", "u", None])
        logid = rnd.randrange(10_000) if w == "m" else None if w == "u" and rnd.random() < 0.1 else i * 2
        rows.append(dict(warehouse=rnd.choice(["whracks2", None]), logid=logid, emailaddress=w, modulename=rnd.choice([*MODULES, "login"]),
                         status=rnd.choice(["in", "out", "break"]), actiontime=T("2024-01-08 00:00") + dt.timedelta(seconds=sec)))
    return rows


def _plain(log, w):
    return sorted(map(tuple, working_time(session_changes(log, MODULES, w), w).drop("total_working_hrs").collect()), key=str)


def test_any_window_from_stored_days_equals_the_log(spark):
    log = role_df(spark, "worklog", _log(5)).checkpoint()
    stored = sg.day_segments(log, MODULES, block=8).checkpoint()
    for start, end in (("2024-01-08 00:00:00", "2024-01-13 23:59:59"), ("2024-01-09 07:30:00", "2024-01-12 15:10:00"),
                       ("2024-01-10 06:00:00", "2024-01-10 21:00:00"), ("2024-01-09 22:00:00", "2024-01-10 03:00:00"), ("2025-01-01 00:00:00", "2025-01-02 00:00:00")):
        w = ReportWindow.of(start, end)
        got = sg.window_time(stored, log, MODULES, w, block=8).drop("total_working_hrs").collect()
        assert sorted(map(tuple, got), key=str) == _plain(log, w), (start, end)


def test_segments_are_associative(spark):
    rows = [r for r in _log(8) if r["emailaddress"] in ("a", "b")]
    days = sg.day_segments(role_df(spark, "worklog", rows), MODULES).checkpoint()
    halves = sg.combined(days.withColumn("half", F.col("day") < F.lit("2024-01-11").cast("date")), [*sg.WORKER, "half"])
    names = [*sg.WORKER, *sg.RECORD]
    two_steps = sg.combined(halves.drop("mixed")).select(*names).collect()
    assert sorted(map(tuple, two_steps), key=str) == sorted(map(tuple, sg.combined(days).select(*names).collect()), key=str)


def test_worker_numbers_are_kept_and_dense(spark):
    names = lambda a, b: spark.createDataFrame([(f"w{i}",) for i in range(a, b)] + [(None,)], "emailaddress string")
    first = distinct.worker_ids(names(0, 300)).checkpoint()
    both = distinct.worker_ids(names(200, 700), first)
    ids = {r["emailaddress"]: r["id"] for r in both.collect()}
    assert len(ids) == len(set(ids.values())) == 700 and max(ids.values()) < 4 * 700
    assert all(ids[r["emailaddress"]] == r["id"] for r in first.collect())


def test_users_stream_takes_late_and_repeated_rows_once(spark, monkeypatch):
    monkeypatch.setattr(hourly_users, "COMPACT", 2)
    rnd = random.Random(4)
    rows = [("whracks2", rnd.choice(["Picking", "QC"]), T(DAY + f"{rnd.randint(6, 9):02d}:{rnd.randint(0, 59):02d}"), rnd.choice([None, *(f"w{i}" for i in range(30))])) for _ in range(200)]
    frame = lambda r: spark.createDataFrame(r, "warehouse string, process string, lastmodifieddate timestamp_ntz, emailaddress string")
    tgt = os.path.join(checkpoint_dir(spark), f"users-{uuid.uuid4().hex}")
    assert hourly_users.users_so_far(spark, tgt).count() == 0
    store = Snapshots(spark, tgt)
    for i, part in enumerate((rows[:90], rows[50:150], rows[140:])):
        for _ in range(2):  # the second time is a replay
            hourly_users.take(store, frame(part), i)
    want = {}
    for w, p, t, u in rows:
        if u is not None:
            want.setdefault((w, p, t.replace(minute=0)), set()).add(u)
    assert sorted(map(tuple, hourly_users.users_so_far(spark, tgt).collect())) == sorted((*k, len(v)) for k, v in want.items())
    by_process = {r["process"]: r["Distinct_User"] for r in hourly_users.users_so_far(spark, tgt, "process").collect()}
    assert by_process == {p: len(set().union(*(v for k, v in want.items() if k[1] == p))) for p in ("Picking", "QC")}


def test_a_late_row_repairs_exactly_its_hour(spark):
    r, tgt = roles(spark), os.path.join(checkpoint_dir(spark), f"late-{uuid.uuid4().hex}")
    day = ReportWindow.of(DAY + "09:00:00", DAY + "12:59:59")
    late_hours.load_with_digests(spark, r, tgt, day)
    assert late_hours.repair(spark, r, tgt, day) == []
    items = [item(1, "09:10"), item(2, "09:40", "b"), item(3, "10:20"), item(4, "11:05", "b"), item(5, "12:30"), item(6, "11:50", "c", 7.0)]
    more = make_roles(spark, items=items, tasks=[x.asDict() for x in r.tasks.collect()], worklog=[x.asDict() for x in r.worklog.collect()])
    again = late_hours.repair(spark, more, tgt, day)
    assert [(w.start, w.end) for w in again] == [(T(DAY + "11:00"), T(DAY + "11:59:59"))]
    got = {h["timestamp"].hour: (h["QTY"], h["Distinct_User"]) for h in Snapshots(spark, tgt).read("hourly").collect()}
    want = {h["timestamp"].hour: (h["QTY"], h["Distinct_User"]) for h in hourly_report(hourly_pipeline(more, day)).collect()}
    assert got == want and got[11] == (9.0, 2)
    assert late_hours.repair(spark, more, tgt, day) == []
