import datetime as dt
import os
import uuid

import pytest
from conftest import T, make_roles
from pyspark.sql import functions as F

from opsmetrics.functions.windows import ReportWindow
from opsmetrics.plans.hourly import daily_report, hourly_pipeline, hourly_report
from opsmetrics.plans.incremental import next_window_frame, run_increment
from opsmetrics.session import checkpoint_dir
from opsmetrics.sources import sinks
from opsmetrics.streaming.hourly_items import run_available

DAY = "2024-01-08 "


def item(i, t, worker="a", q=2.0):
    return dict(item_table="pick", tier="archive", warehouse="whracks10", id=i, emailaddress=worker, businesstype="B2B",
                quantity=q, processquantity=q, notfoundquantity=0.0, productid=1, taskid=7,
                lastmodifieddate=T(DAY + t))


def roles(spark):
    items = [item(1, "09:10"), item(2, "09:40", "b"), item(3, "10:20"), item(4, "11:05", "b"), item(5, "12:30")]
    tasks = [dict(tier="archive", warehouse="whracks10", taskid=7, tasktype="Picking", taskname="x", startdate=T(DAY + "08:00"),
                  enddate=T(DAY + "13:00"))]
    log = [dict(warehouse="whracks10", logid=i, emailaddress=w, modulename="wave_picking", status=s,
                actiontime=T(DAY + t)) for i, (w, s, t) in
           enumerate([("a", "in", "09:05"), ("a", "out", "09:50"), ("b", "in", "09:30"), ("a", "in", "10:10"),
                      ("a", "out", "10:40"), ("b", "out", "11:20")])]
    return make_roles(spark, items=items, tasks=tasks, worklog=log)


def target(spark):
    return os.path.join(checkpoint_dir(spark), f"inc-{uuid.uuid4().hex}")


def test_two_runs_and_rerun_are_idempotent(spark):
    r = roles(spark)
    tgt = target(spark)
    w1 = run_increment(spark, r, tgt, dt.datetime(2024, 1, 8, 11, 5), bootstrap=dt.datetime(2024, 1, 8, 9))
    assert (w1.start, w1.end) == (T(DAY + "09:00"), T(DAY + "10:59:59"))
    assert run_increment(spark, r, tgt, dt.datetime(2024, 1, 8, 11, 5)) is None  # nothing new in this hour
    w2 = run_increment(spark, r, tgt, dt.datetime(2024, 1, 8, 13, 0))
    assert (w2.start, w2.end) == (T(DAY + "11:00"), T(DAY + "12:59:59"))
    hourly = {r_.timestamp.hour: r_.QTY for r_ in spark.read.parquet(f"{tgt}/hourly").collect()}
    assert hourly == {9: 4.0, 10: 2.0, 11: 2.0, 12: 2.0}
    daily = spark.read.parquet(f"{tgt}/daily").collect()
    assert len(daily) == 1 and daily[0].QTY == 10.0 and daily[0].Distinct_User == 2
    # Re-running the second window (e.g. after a failure) leaves the same tables.
    sinks.overwrite_partitions(spark.read.parquet(f"{tgt}/hourly").where("hour(timestamp) < 11"), f"{tgt}/hourly", ("date",))
    run_increment(spark, r, tgt, dt.datetime(2024, 1, 8, 13, 0))
    daily2 = spark.read.parquet(f"{tgt}/daily").collect()
    assert [tuple(x) for x in daily2] == [tuple(x) for x in daily]


def test_append_mode_keeps_one_row_per_run(spark):
    r = roles(spark)
    tgt = target(spark)
    run_increment(spark, r, tgt, dt.datetime(2024, 1, 8, 11, 5), mode="append", bootstrap=dt.datetime(2024, 1, 8, 9))
    run_increment(spark, r, tgt, dt.datetime(2024, 1, 8, 13, 0), mode="append")
    daily = spark.read.parquet(f"{tgt}/daily").collect()
    assert sorted(d.QTY for d in daily) == [4.0, 6.0]  # one partial row per run and day


def test_next_window_frame(spark):
    res = spark.createDataFrame([(T(DAY + "09:00"),)], "timestamp timestamp_ntz")
    row = next_window_frame(res, dt.datetime(2024, 1, 8, 12, 34, 56)).collect()
    assert [(x.start_date, x.end_date) for x in row] == [(T(DAY + "10:00"), T(DAY + "11:59:59"))]
    assert next_window_frame(res, dt.datetime(2024, 1, 8, 9, 34)).count() == 0
    empty = res.where("false")
    row = next_window_frame(empty, dt.datetime(2024, 1, 8, 12, 0), bootstrap=T(DAY + "08:00")).collect()
    assert row[0].start_date == T(DAY + "08:00")


def test_csv_round_trip_with_interval(spark):
    from opsmetrics.plans.reports import report

    r = roles(spark)
    w = ReportWindow.of(DAY + "09:00:00", DAY + "12:59:59")
    df = report(r, "report_picking", w)
    path = target(spark)
    sinks.write_csv(df, path)
    back = spark.read.option("header", True).csv(path)
    assert back.count() == df.count()
    assert back.drop("for_warehouse").columns == df.columns
    assert os.path.isdir(os.path.join(path, "for_warehouse=whracks10"))


def test_csv_files_hold_the_warehouse_and_the_worker_order(spark):
    df = spark.createDataFrame([("w%02d" % (i * 7 % 20), "whracks2", i) for i in range(20)], "emailaddress string, warehouse string, n int")
    path = sinks.write_report(df.repartition(4), target(spark), "report_x", dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 9, 1, 2, 3))
    assert path.endswith("/report_x/start=2024-01-08/run=20240109010203")
    folder = os.path.join(path, "for_warehouse=whracks2")
    for name in (n for n in os.listdir(folder) if n.endswith(".csv")):
        head, *rows = open(os.path.join(folder, name)).read().split()
        assert head == "emailaddress,warehouse,n" and rows == sorted(rows) and all(",whracks2," in r for r in rows)


def test_a_read_error_is_not_a_missing_table(spark):
    assert not sinks.table_exists(spark, target(spark))
    with pytest.raises(Exception):  # noqa: B017, PT011 - whatever the file system says
        sinks.table_exists(spark, "nosuchscheme://x/y")


def test_dates_without_rows_are_emptied_and_staging_is_cleared(spark):
    from opsmetrics.plans.incremental import run_window

    r, tgt = roles(spark), target(spark)
    w = ReportWindow.of(DAY + "00:00:00", DAY + "23:59:59")
    run_window(spark, r, tgt, w)
    before = set(os.listdir(checkpoint_dir(spark)))
    assert spark.read.parquet(f"{tgt}/daily").count() == 1
    run_window(spark, r.with_role("items", r.items.where("false")), tgt, w)
    for table in ("raw", "daily", "hourly"):
        assert spark.read.parquet(f"{tgt}/{table}").count() == 0, table
    run_window(spark, r, tgt, w)
    assert spark.read.parquet(f"{tgt}/daily").count() == 1
    assert set(os.listdir(checkpoint_dir(spark))) == before
    stages = [s for s in before if s.startswith("raw-stage-")]
    assert all(spark.read.parquet(os.path.join(checkpoint_dir(spark), s)).count() == 0 for s in stages)


def test_touched_days_are_distinct(spark):
    from opsmetrics.streaming.hourly_job import touched_days

    rows = [(T("2023-01-08 10:00"),), (T(DAY + "10:00"),), (T("2024-01-09 01:00"),), (T("2024-01-09 02:00"),), (None,)]
    got = [(w.start_text, w.end_text) for w in touched_days(spark.createDataFrame(rows, "actiontime timestamp_ntz"))]
    assert got == [("2023-01-08 00:00:00", "2023-01-08 23:59:59"), ("2024-01-08 00:00:00", "2024-01-09 23:59:59")]


def test_hourly_job_sees_later_files(spark):
    from opsmetrics.sources.roles import Roles
    from opsmetrics.streaming.hourly_job import start_hourly_job

    r, base = roles(spark), target(spark)
    log = r.worklog
    schema = log.schema
    landing = f"{base}/landing"
    loaders = {n: (lambda n=n: getattr(r, n)) for n in ("items", "tasks", "productdetails")}
    live = Roles(spark, loaders | {"worklog": lambda: spark.read.schema(schema).parquet(landing)})

    def land(part):
        part.coalesce(1).write.mode("append").parquet(landing)
        start_hourly_job(spark, live, landing, f"{base}/out", f"{base}/ck").awaitTermination()

    land(log.where("logid <= 1"))
    land(log.where("logid > 1"))
    got = {(x.emailaddress, x.timestamp.hour): x.working_sec for x in spark.read.parquet(f"{base}/out/raw").collect()}
    fresh = {(x.emailaddress, x.timestamp.hour): x.working_sec
             for x in hourly_pipeline(r, ReportWindow.of(DAY + "00:00:00", DAY + "23:59:59")).collect()}
    assert got == fresh and got[("a", 10)] == 1800.0


def test_stream_emits_every_hour(spark):
    r = roles(spark)
    w = ReportWindow.of(DAY + "09:00:00", DAY + "12:59:59")
    base = target(spark)
    from opsmetrics.plans.hourly import pick_detail

    detail = pick_detail(r.items, r.tasks, w)
    sinks.append(detail.withColumn("day", F.to_date("lastmodifieddate")), f"{base}/in", ("day",))
    out = run_available(spark, f"{base}/in", r.productdetails, f"{base}/out", f"{base}/ck", delay="0 seconds")
    got = {x.timestamp.hour: x.QTY for x in out.collect()}
    assert got == {9: 4.0, 10: 2.0, 11: 2.0, 12: 2.0}  # 12:00 is still open (latest event 12:30)
    batch = hourly_report(hourly_pipeline(r, w)).collect()
    assert {x.timestamp.hour: x.QTY for x in batch} == got


def test_stream_of_several_batches_counts_once(spark):
    from opsmetrics.plans.hourly import pick_detail

    r, base = roles(spark), target(spark)
    detail = pick_detail(r.items, r.tasks, ReportWindow.of(DAY + "09:00:00", DAY + "12:59:59"))
    for h in ("lastmodifieddate < '2024-01-08 09:30:00'", "lastmodifieddate >= '2024-01-08 09:30:00'"):
        detail.where(h).coalesce(1).write.mode("append").parquet(f"{base}/in")
        out = run_available(spark, f"{base}/in", r.productdetails, f"{base}/out", f"{base}/ck", delay="1 hour")
    assert {x.timestamp.hour: x.QTY for x in out.collect()} == {9: 4.0, 10: 2.0, 11: 2.0, 12: 2.0}


def test_stream_sink_is_compacted_and_takes_a_batch_once(spark):
    from opsmetrics.sources.snapshots import Snapshots
    from opsmetrics.streaming import hourly_items

    base = target(spark)
    store = Snapshots(spark, base)

    def totals(*hours):
        rows = [("w", "Picking", T(f"{DAY}{h:02d}:00"), q, 0.0, 0.0, q) for h, q in hours]
        return spark.createDataFrame(rows, hourly_items.TOTALS)

    expected = {}
    for n in range(7):
        hours = [(n, float(n)), (n + 1, n + 0.5)]  # each hour is open in one batch and changed by the next
        expected |= dict(hours)
        made = hourly_items.take(store, totals(*hours), n, compact=3)
        assert len(made.tables["totals"]) < 3
        again = hourly_items.take(store, totals((n, 99.0)), n, compact=3)  # replayed
        assert again.version == made.version
        got = [(r.timestamp.hour, r.QTY) for r in hourly_items.current_totals(spark, base).collect()]
        assert len(got) == len(expected) and dict(got) == expected
    assert len(store._list("totals")) <= 4  # old folders are gone
    assert hourly_items.current_totals(spark, target(spark)).count() == 0
