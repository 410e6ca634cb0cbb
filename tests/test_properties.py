"""Property tests: operators against brute-force Python on random inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import role_df
from opsmetrics.functions.windows import ReportWindow, overlaps
from opsmetrics.operators.sessions import hourly_working_time, session_changes, working_time
from opsmetrics.functions.labels import classify_module
from opsmetrics.spec import HOUR_SECONDS

BASE = dt.datetime(2024, 1, 8, 9, 0)
W = ReportWindow(BASE, BASE + dt.timedelta(hours=3) - dt.timedelta(seconds=1))
MODS = ["wave_picking", "qc_shipping", "login"]

log_rows = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", None]),
        st.sampled_from(["in", "out", "break"]),
        st.integers(min_value=-600, max_value=3 * 3600 + 600),  # seconds from 09:00, some outside the window
        st.sampled_from(MODS),
        st.integers(min_value=0, max_value=999),  # micro fraction
    ),
    min_size=0,
    max_size=40,
)

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _log(spark, rows):
    data = [dict(warehouse="wh", logid=i, emailaddress=w, status=s, modulename=m,
                 actiontime=BASE + dt.timedelta(seconds=t, microseconds=f)) for i, (w, s, t, m, f) in enumerate(rows)]
    return data, role_df(spark, "worklog", data)


def _changes(data, modules):
    kept = [r for r in data if W.start <= r["actiontime"] <= W.end and r["status"] in ("in", "out")
            and r["modulename"] in modules]
    out, prev = [], {}
    for r in sorted(kept, key=lambda r: r["logid"]):
        k = (r["warehouse"], r["emailaddress"])
        if prev.get(k) != r["status"]:
            out.append(r)
        prev[k] = r["status"]
    return out


def _us(a, b):
    d = b - a
    return (d.days * 86400 + d.seconds) * 1_000_000 + d.microseconds


@SETTINGS
@given(rows=log_rows, block=st.sampled_from([1, 3, 1 << 20]))
def test_working_time_matches_brute_force(spark, rows, block):
    data, df = _log(spark, rows)
    got = {r.emailaddress: r.total_working_seconds
           for r in working_time(session_changes(df, ["wave_picking"], W, block=block), W).collect()}
    exp = {}
    by = {}
    for r in _changes(data, ["wave_picking"]):
        by.setdefault(r["emailaddress"], []).append(r)
    for w, rs in by.items():
        outs = [_us(W.start, r["actiontime"]) for r in rs if r["status"] == "out"]
        ins = [_us(W.start, r["actiontime"]) for r in rs if r["status"] == "in"]
        if not outs or not ins:
            exp[w] = None
            continue
        t = sum(outs) - sum(ins)
        if t < 0:
            t += W.length_micros
        exp[w] = t / 1e6
    assert got == exp


@SETTINGS
@given(rows=log_rows)
def test_hourly_time_matches_brute_force(spark, rows):
    data, df = _log(spark, rows)
    ch = session_changes(df.withColumn("process", classify_module("modulename")), MODS[:2], W)
    got = {(r.emailaddress, r.process, r.timestamp): r.working_sec for r in hourly_working_time(ch).collect()}
    exp = {}
    proc = {"wave_picking": "Picking", "qc_shipping": "QC"}
    for r in _changes(data, MODS[:2]):
        if r["emailaddress"] is None:
            continue
        hour = r["actiontime"].replace(minute=0, second=0, microsecond=0)
        k = (r["emailaddress"], proc[r["modulename"]], hour)
        sign = 1 if r["status"] == "out" else -1
        exp[k] = exp.get(k, 0) + sign * _us(hour, r["actiontime"])
    exp = {k: (v + HOUR_SECONDS * 1_000_000 if v < 0 else v) / 1e6 for k, v in exp.items()}
    assert got == exp


intervals = st.lists(
    st.tuples(st.integers(min_value=-5, max_value=20), st.one_of(st.none(), st.integers(min_value=-5, max_value=20))),
    min_size=1, max_size=30,
)


@SETTINGS
@given(rows=intervals)
def test_overlap_matches_four_between(spark, rows):
    w = ReportWindow(BASE, BASE + dt.timedelta(hours=10))
    hour = lambda h: None if h is None else BASE + dt.timedelta(hours=h)
    df = spark.createDataFrame([(i, hour(a), hour(b)) for i, (a, b) in enumerate(rows)],
                               "i int, startdate timestamp_ntz, enddate timestamp_ntz")
    got = sorted(r.i for r in df.where(overlaps("startdate", "enddate", w)).collect())

    def between(x, lo, hi):
        if x is None or lo is None or hi is None:
            return None
        return lo <= x <= hi

    def or3(*vals):  # SQL three-valued OR
        if any(v is True for v in vals):
            return True
        return None if any(v is None for v in vals) else False

    exp = []
    for i, (a, b) in enumerate(rows):
        s, e = hour(a), hour(b)
        if or3(between(s, w.start, w.end), between(e, w.start, w.end), between(w.start, s, e), between(w.end, s, e)):
            exp.append(i)
    assert got == exp
