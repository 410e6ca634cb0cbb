import datetime as dt
import itertools
import os
import uuid

import pytest
from conftest import T, make_roles, role_df
from test_incremental import DAY, item, roles

from opsmetrics.functions.windows import ReportWindow
from opsmetrics.operators.sessions import hourly_time as batch_time
from opsmetrics.plans.committed import load_committed, mark_of, run_committed
from opsmetrics.plans.hourly import daily_report, hourly_pipeline, hourly_report
from opsmetrics.session import checkpoint_dir
from opsmetrics.sources.snapshots import Snapshots
from opsmetrics.streaming import hourly_time as st

WHOLE = ReportWindow.of(DAY + "00:00:00", DAY + "23:59:59")


def target(spark):
    return os.path.join(checkpoint_dir(spark), f"committed-{uuid.uuid4().hex}")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def state(spark, tgt):
    store = Snapshots(spark, tgt)
    head = store.head()
    return head.version, mark_of(head), *(rows(store.read(t, head)) if store.read(t, head) is not None else None for t in ("raw", "daily", "hourly"))


def test_runs_equal_one_whole_load(spark):
    r, tgt = roles(spark), target(spark)
    w1 = run_committed(spark, r, tgt, dt.datetime(2024, 1, 8, 11, 5), bootstrap=T(DAY + "09:00"))
    assert (w1.start, w1.end) == (T(DAY + "09:00"), T(DAY + "10:59:59"))
    assert run_committed(spark, r, tgt, dt.datetime(2024, 1, 8, 11, 5)) is None
    run_committed(spark, r, tgt, dt.datetime(2024, 1, 8, 13, 0))
    store = Snapshots(spark, tgt)
    daily = store.read("daily").collect()
    assert [(d["QTY"], d["Distinct_User"]) for d in daily] == [(10.0, 2)]
    assert {h["timestamp"].hour: h["QTY"] for h in store.read("hourly").collect()} == {9: 4.0, 10: 2.0, 11: 2.0, 12: 2.0}
    assert mark_of(store.head()) == T(DAY + "12:00")


class Broken:
    """A file system that renames nothing: the draft is there, the commit is not."""

    def __init__(self, fs):
        self.fs = fs

    def __getattr__(self, name):
        return (lambda *a: False) if name == "rename" else getattr(self.fs, name)


@pytest.mark.parametrize("mode", ["upsert", "append"])
def test_a_failure_between_any_two_writes_leaves_the_old_state(spark, monkeypatch, mode):
    r, tgt = roles(spark), target(spark)
    run_committed(spark, r, tgt, dt.datetime(2024, 1, 8, 11, 5), mode, bootstrap=T(DAY + "09:00"))
    before = state(spark, tgt)
    real, files = Snapshots.write, Snapshots._files
    for step in ("write 1", "write 2", "write 3", "commit", "rename"):
        calls = itertools.count(1)

        def write(self, *a, **k):
            made = real(self, *a, **k)
            if step == f"write {next(calls)}":  # noqa: B023
                raise OSError(step)  # noqa: B023
            return made

        def commit(*a, **k):
            raise OSError("commit")

        with monkeypatch.context() as m:
            m.setattr(Snapshots, "write", write)
            if step == "commit":
                m.setattr(Snapshots, "commit", commit)
            if step == "rename":
                m.setattr(Snapshots, "_files", lambda self: Broken(files(self)))
            with pytest.raises((OSError, RuntimeError)):
                run_committed(spark, r, tgt, dt.datetime(2024, 1, 8, 13, 0), mode)
        assert state(spark, tgt) == before, step
    run_committed(spark, r, tgt, dt.datetime(2024, 1, 8, 13, 0), mode)
    after = state(spark, tgt)
    assert sorted(d[3] for d in after[3]) == ([10.0] if mode == "upsert" else [4.0, 6.0])
    # What the failed runs wrote goes with the next vacuum, and no row with it.
    store = Snapshots(spark, tgt)
    store.vacuum(1)
    folders = {f.split("/")[1] for parts in store.head().tables.values() for f in parts.values()}
    assert {f for t in ("raw", "daily", "hourly") for f in os.listdir(f"{tgt}/{t}") if f.startswith("v")} == folders
    assert state(spark, tgt)[1:] == after[1:]


def test_append_is_idempotent_by_run_and_upsert_empties_days(spark):
    r, tgt = roles(spark), target(spark)
    w = ReportWindow.of(DAY + "09:00:00", DAY + "10:59:59")
    for _ in range(2):
        load_committed(spark, r, tgt, w, "append")
    assert [d["QTY"] for d in Snapshots(spark, tgt).read("daily").collect()] == [6.0]
    up = target(spark)
    load_committed(spark, r, up, WHOLE)
    load_committed(spark, make_roles(spark, items=[], tasks=[], worklog=[]), up, WHOLE)
    assert all(Snapshots(spark, up).read(t).count() == 0 for t in ("raw", "daily", "hourly"))


def test_old_versions_are_removed_and_a_second_writer_is_refused(spark):
    tgt = target(spark)
    store = Snapshots(spark, tgt)
    assert store.head().version == 0 and store.read("a") is None
    for i in range(4):
        head = store.head()
        store.commit(head, {"a": store.write(spark.createDataFrame([(i,)], "n long"), "a")})
    with pytest.raises(RuntimeError):
        store.commit(head, {"a": store.write(spark.createDataFrame([(9,)], "n long"), "a")})
    store.vacuum(1)
    assert rows(store.read("a")) == [(3,)]
    assert sorted(f.split("-")[0] for f in os.listdir(f"{tgt}/a") if f.startswith("v")) == ["v4", "v5"]  # v5: of the refused writer
    assert len([n for n in os.listdir(f"{tgt}/_commits") if n.endswith(".json")]) == 1


# ---- the working-time stream ------------------------------------------------------------------------------------------


def log_rows(n=240, workers=("a", "b", "c", None)):
    import random

    rnd = random.Random(11)
    modules = ["wave_picking", "bin_packing", "qc_shipping", "login"]
    out, at = [], T(DAY + "06:00")
    for i in range(n):
        at += dt.timedelta(seconds=rnd.randint(0, 300))
        out.append(dict(warehouse=rnd.choice(["whracks10", "whracks2", None]), logid=i * 3, emailaddress=rnd.choice(workers),
                        modulename=rnd.choice(modules), status=rnd.choice(["in", "out", "break"]), actiontime=at))
    return out


def settled(spark, tgt, batches, delay):
    store = Snapshots(spark, tgt)
    for i, b in enumerate(batches):
        st.settle(store, role_df(spark, "worklog", b), i, WHOLE, delay, block=16)


def want(spark, log):
    return rows(batch_time(role_df(spark, "worklog", log), WHOLE))


def test_stream_equals_batch_out_of_order_with_replays_and_failures(spark, monkeypatch):
    log, tgt = log_rows(), target(spark)
    log[100]["logid"] = None  # sorts last, whenever it comes
    late = [r for i, r in enumerate(log) if i % 9 == 0]
    cut = [log[:80], log[80:160], log[160:]]
    batches = [[r for r in c if r not in late] + [r for r in (cut[i - 1] if i else []) if r in late] for i, c in enumerate([*cut, []])]
    delay = dt.timedelta(hours=8)
    store = Snapshots(spark, tgt)
    seen = []
    for i, b in enumerate(batches):
        with monkeypatch.context() as m:  # a batch that fails before its commit is taken again

            def commit(*a, **k):
                raise OSError("lost")

            m.setattr(Snapshots, "commit", commit)
            with pytest.raises(OSError):
                st.settle(store, role_df(spark, "worklog", b), i, WHOLE, delay, block=16)
        for _ in range(2):  # one that is replayed after it changes nothing
            st.settle(store, role_df(spark, "worklog", b), i, WHOLE, delay, block=16)
        seen += b
        assert rows(st.hourly_time_so_far(spark, tgt, block=16)) == want(spark, seen)
    assert st.late_days(spark, tgt).count() == 0
    assert store.read("edges").count() > 0 and 0 < store.read("waiting").count() < len(log)


def test_late_rows_are_kept_apart(spark):
    log, tgt = log_rows(), target(spark)
    old = dict(next(r for r in log[10:] if r["status"] == "in" and r["emailaddress"] and r["modulename"] != "login"), logid=1)
    settled(spark, tgt, [log[:200], log[200:], [old]], dt.timedelta(0))
    assert rows(st.hourly_time_so_far(spark, tgt)) == want(spark, log)
    assert [tuple(r) for r in st.late_days(spark, tgt).collect()] == [(old["actiontime"].date(), 1)]


def test_parts_are_added_up(spark, monkeypatch):
    monkeypatch.setattr(st, "COMPACT", 3)
    log, tgt = log_rows(120), target(spark)
    settled(spark, tgt, [log[i : i + 30] for i in range(0, 120, 30)], dt.timedelta(minutes=10))
    head = Snapshots(spark, tgt).head()
    assert len(head.keys("turns")) <= 2 and rows(st.hourly_time_so_far(spark, tgt)) == want(spark, log)


def test_stream_before_any_row(spark):
    tgt = target(spark)
    assert st.hourly_time_so_far(spark, tgt).count() == 0
    settled(spark, tgt, [[]], dt.timedelta(hours=1))
    assert st.hourly_time_so_far(spark, tgt).count() == 0
