"""Registered queries over the provided test tables, and their oracle SQL.

Every query maps the provided tables onto the role tables
(``sources.testdata``) and runs the full report over them.  The report
window is the whole month the data covers, so every row takes part.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import catalog, oracle
from .functions.windows import DAY, ReportWindow
from .operators import intervals, segments
from .operators.items import overlapping_tasks
from .plans import catch_up, committed, distinct, hourly, incremental, late_hours, receipts, reports, sql_reports
from .session import checkpoint_dir
from .sources import bucketed, report_files, sinks
from .sources.snapshots import Snapshots
from .sources.roles import Roles
from .streaming import hourly_items, hourly_job, hourly_time, hourly_users, pick_time
from .sources.testdata import source_state, testdata_roles
from .spec import PICKING

# Whole month of the test data (every item, task and log row lies inside).
MONTH = ReportWindow.of("2024-01-01 00:00:00", "2024-01-31 23:59:59")
# "now" of a run just after the month: the next window ends 2024-01-31 23:59:59.
AFTER_MONTH = dt.datetime(2024, 2, 1, 0, 30)
# Two consecutive hourly-job runs that together cover the month.
RUNS = (dt.datetime(2024, 1, 16, 0, 30), AFTER_MONTH)
BOOTSTRAP = dt.datetime(2024, 1, 1, 0, 0)

QueryFn = Callable[[SparkSession, str], DataFrame]


def _report(key: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return reports.report(testdata_roles(spark, sf_dir), key, MONTH, hours_as="hours")

    run.__name__ = key
    return run


def q_hourly_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.hourly_time(testdata_roles(spark, sf_dir).worklog, MONTH).drop("working_us")


def q_pick_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = testdata_roles(spark, sf_dir)
    return hourly.pick_detail(r.items, r.tasks, MONTH)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.hourly_pipeline(testdata_roles(spark, sf_dir), MONTH)


def q_productivity_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).drop("working_us")


def q_hourly_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.hourly_report(_raw(spark, sf_dir))


def q_daily_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.daily_report(_raw(spark, sf_dir))


def q_grc_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return receipts.grc_report(testdata_roles(spark, sf_dir), MONTH)


def _scratch(spark: SparkSession, name: str) -> str:
    """Fresh folder under the shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = reports.report(testdata_roles(spark, sf_dir), "report_picking", MONTH, hours_as="hours", order=False)
    path = sinks.write_report(df, _scratch(spark, "csv"), "report_picking", MONTH.start)
    return sinks.read_csv(spark, path, df.schema).select(*df.columns)


def q_sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "append")  # also registers the shared checkpoint folder
    daily = hourly.daily_report(_raw(spark, sf_dir)).checkpoint()  # computed once, appended twice
    sinks.append(daily, path)
    sinks.append(daily, path)
    return spark.read.parquet(path)


# (application, folder) -> (state of the source tables, the hourly results table loaded from them)
_LOADED: dict[tuple[str, str], tuple[tuple, str]] = {}


def _hourly_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly results table of one loaded run over the month, written when it is first asked for and when its sources have changed."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    state = source_state(spark, sf_dir, ("items", "tasks", "worklog", "productdetails"))
    if key not in _LOADED or _LOADED[key][0] != state:
        target = _scratch(spark, "loaded")
        incremental.run_window(spark, testdata_roles(spark, sf_dir), target, MONTH)
        _LOADED[key] = (state, f"{target}/hourly")
    return spark.read.parquet(_LOADED[key][1])


def q_high_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.high_watermark(_hourly_table(spark, sf_dir))


def q_next_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.next_window_frame(_hourly_table(spark, sf_dir), AFTER_MONTH)


def q_incremental_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    roles = testdata_roles(spark, sf_dir)
    target = _scratch(spark, "increment")
    for now in RUNS:
        incremental.run_increment(spark, roles, target, now, mode="upsert", bootstrap=BOOTSTRAP)
    return spark.read.parquet(f"{target}/daily")


def q_incremental_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same runs with raw, daily and hourly rows in one commit each."""
    roles = testdata_roles(spark, sf_dir)
    target = _scratch(spark, "committed")
    for now in RUNS:
        committed.run_committed(spark, roles, target, now, bootstrap=BOOTSTRAP)
    return Snapshots(spark, target).read("daily")


def q_stream_hourly_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    roles = testdata_roles(spark, sf_dir)
    base = _scratch(spark, "stream")
    detail = hourly.pick_detail(roles.items, roles.tasks, MONTH)
    sinks.append(detail.withColumn("day", F.to_date("lastmodifieddate")), f"{base}/in", ("day",))
    return hourly_items.run_available(
        spark, f"{base}/in", roles.productdetails, f"{base}/out", f"{base}/checkpoint", delay="0 seconds"
    )


def q_stream_hourly_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log-driven streaming form: new log files trigger recomputation of the days they touch."""
    roles = testdata_roles(spark, sf_dir)
    base = _scratch(spark, "hourly-job")
    sinks.append(roles.worklog.drop(DAY), f"{base}/landing")  # the log as it lands
    q = hourly_job.start_hourly_job(spark, roles, f"{base}/landing", f"{base}/out", f"{base}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out/daily")


# The log lands in slices of eight days; a tenth of each comes with the next one, so rows wait out of order.
SLICE_DAYS, LATER, SLICE_DELAY = 8, 10, dt.timedelta(days=17)


def q_stream_hourly_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Working time with each worker's last status carried between micro-batches; the query is started anew for each slice."""
    log = testdata_roles(spark, sf_dir).worklog.drop(DAY)
    base = _scratch(spark, "stream-time")
    nth = F.floor((F.dayofmonth("actiontime") - 1) / SLICE_DAYS) + F.when(F.col("logid") % LATER == 0, 1).otherwise(0)
    for i in range(31 // SLICE_DAYS + 2):
        sinks.append(log.where(nth == i), f"{base}/landing")
        found = hourly_time.run_available(spark, f"{base}/landing", f"{base}/out", f"{base}/checkpoint", MONTH, SLICE_DELAY)
    return found.drop("working_us")


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = _scratch(spark, name)
    sinks.append(df, path)
    return spark.read.schema(df.schema).parquet(path)


def q_daily_from_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table from stored hours with bitmaps of their workers; no worker-hour is read again."""
    raw = _stored(spark, _raw(spark, sf_dir), "raw")
    ids = _stored(spark, distinct.worker_ids(raw), "worker-ids")
    return distinct.daily_from_parts(_stored(spark, distinct.hourly_parts(raw, ids), "hourly-parts"))


def q_stream_hourly_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct workers of every hour from a stream of item rows that lands in three slices."""
    roles = testdata_roles(spark, sf_dir)
    base = _scratch(spark, "stream-users")
    detail = _stored(spark, hourly.pick_detail(roles.items, roles.tasks, MONTH), "detail")
    for first in (1, 11, 21):
        sinks.append(detail.where(F.dayofmonth("lastmodifieddate").between(first, first + (9 if first < 21 else 10))), f"{base}/in")
        found = hourly_users.run_available(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint")
    return found


def q_stream_pick_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Worker-hour totals and working time as two streams that land in slices and are joined when their hours close."""
    roles = testdata_roles(spark, sf_dir)
    base = _scratch(spark, "stream-pick-time")
    detail = _stored(spark, hourly.pick_detail(roles.items, roles.tasks, MONTH), "detail")
    time = _stored(spark, hourly.hourly_time(roles.worklog, MONTH).select(*hourly.RAW_KEYS, "working_us"), "time")
    for first, last in ((1, 15), (16, 31)):
        sinks.append(detail.where(F.dayofmonth("lastmodifieddate").between(first, last)), f"{base}/items")
        sinks.append(time.where(F.dayofmonth("timestamp").between(first, last)), f"{base}/time")
        if last == 31:  # the last hours close
            for mark, name in zip(pick_time.end_mark(spark, AFTER_MONTH + dt.timedelta(days=1)), ("items", "time")):
                sinks.append(mark, f"{base}/{name}")
        found = pick_time.run_available(spark, f"{base}/items", f"{base}/time", roles.productdetails, f"{base}/out", f"{base}/checkpoint")
    return found.select(*hourly.RAW_KEYS, "Quantity", (F.col("working_us").cast("double") / F.lit(1_000_000.0)).alias("working_sec"))


# A window that starts and ends within a day.
PART_DAYS = ReportWindow.of("2024-01-08 09:30:00", "2024-01-14 17:15:00")


def q_working_seconds_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Working time of a week from stored day segments; only the two edge days are read from the log."""
    log = testdata_roles(spark, sf_dir).worklog
    stored = _stored(spark, segments.day_segments(log, PICKING.modules), "segments")
    time = segments.window_time(stored, log, PICKING.modules, PART_DAYS)
    return time.select("warehouse", "emailaddress", "total_working_seconds")


# The warehouse whose rows come late.
LATE_WAREHOUSE = "whracks12"


def q_late_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours to load again after one warehouse's rows have come late, by the digests of what was loaded."""
    roles = testdata_roles(spark, sf_dir)
    early = Roles(spark, {n: (lambda n=n: getattr(roles, n).where(~F.col("warehouse").eqNullSafe(LATE_WAREHOUSE))) for n in late_hours.SOURCES})
    loaded = _stored(spark, late_hours.hour_digests(early, MONTH), "digests")
    return late_hours.late_hours(loaded, late_hours.hour_digests(roles, MONTH))


def q_catch_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hour of the month as a window of its own, in one plan."""
    rows = catch_up.catch_up(testdata_roles(spark, sf_dir), intervals.hour_windows(spark, MONTH))
    return rows.drop("window_end", "working_us")


# Each day of the month and, across them, shifts of twelve hours from six in the evening and whole weeks.
TASK_WINDOWS = [ReportWindow(MONTH.start + dt.timedelta(hours=at), MONTH.start + dt.timedelta(hours=at + hours, seconds=-1))
                for hours, step, first in ((24, 24, 0), (12, 24, 18), (168, 168, 0)) for at in range(first, 31 * 24, step)]


def q_overlap_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks that overlap each window of a table, by master and type."""
    texts = [(w.start_text, w.end_text) for w in TASK_WINDOWS]
    windows = spark.createDataFrame(texts, "s string, e string")
    windows = windows.select(F.col("s").cast("timestamp_ntz").alias(intervals.START), F.col("e").cast("timestamp_ntz").alias(intervals.END))
    pairs = intervals.overlapping_windows(testdata_roles(spark, sf_dir).tasks, windows)
    return pairs.groupBy(*intervals.WINDOW_KEYS, "tier", "tasktype").agg(F.count(F.lit(1)).alias("n_tasks"))


BUCKETS = 16  # at least


def q_semi_join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of overlapping picking tasks from tables stored in matching buckets; no item is shuffled."""
    roles = testdata_roles(spark, sf_dir)
    name = f"bucketed_{uuid.uuid4().hex}"
    buckets = bucketed.buckets_for(roles.items, roles.tasks, BUCKETS)
    items, tasks = bucketed.store_bucketed(roles.items, roles.tasks, _scratch(spark, "bucketed"), name, buckets).read(spark)
    return bucketed.bucketed_semi_join(items, overlapping_tasks(tasks, PICKING, MONTH)).select(*catalog.ITEM_COLS)


def q_sink_report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The picking report as one stamped CSV file for each warehouse, read back."""
    df = reports.report(testdata_roles(spark, sf_dir), "report_picking", MONTH, hours_as="hours", order=False)
    base = _scratch(spark, "report-files")
    names = report_files.write_files(df, base, "report_picking", MONTH.start)
    return sinks.read_csv(spark, f"{base}/{names}", df.schema)


# Days the test log covers: the streaming job recomputes exactly these.
LOG_DAYS = ReportWindow.of("2024-01-01 00:00:00", "2024-01-30 23:59:59")


def _run_bounds() -> tuple[ReportWindow, list[dt.datetime]]:
    """The first run's window and the ends of the later ones."""
    first, *later = (incremental.next_window(None, now, BOOTSTRAP) for now in RUNS)
    return first, [w.end for w in later]


def q_param_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_reports.sql_report(spark, testdata_roles(spark, sf_dir), "report_picking", MONTH)


def queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {}
    for key in reports.REPORTS:
        out[key] = _report(key)
    out["hourly_time"] = q_hourly_time
    out["pick_detail"] = q_pick_detail
    out["productivity_raw"] = q_productivity_raw
    out["hourly_report"] = q_hourly_report
    out["daily_report"] = q_daily_report
    out["grc_report"] = q_grc_report
    for key, (fn, _) in catalog.build(MONTH).items():
        out[key] = fn
    out["param_report"] = q_param_report
    out["sink_csv"] = q_sink_csv
    out["sink_append"] = q_sink_append
    out["high_watermark"] = q_high_watermark
    out["next_window"] = q_next_window
    out["incremental_run"] = q_incremental_run
    out["incremental_committed"] = q_incremental_committed
    out["daily_from_hourly"] = q_daily_from_hourly
    out["working_seconds_segments"] = q_working_seconds_segments
    out["late_hours"] = q_late_hours
    out["catch_up"] = q_catch_up
    out["overlap_windows"] = q_overlap_windows
    out["semi_join_bucketed"] = q_semi_join_bucketed
    out["sink_report_files"] = q_sink_report_files
    out["stream_hourly_users"] = q_stream_hourly_users
    out["stream_hourly_items"] = q_stream_hourly_items
    out["stream_hourly_time"] = q_stream_hourly_time
    out["stream_pick_time"] = q_stream_pick_time
    out["stream_hourly_job"] = q_stream_hourly_job
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for key in reports.REPORTS:
        out[key] = oracle.report_sql(key, MONTH)
    out["hourly_time"] = oracle.hourly_time_sql(MONTH)
    out["pick_detail"] = oracle.pick_detail_sql(MONTH)
    out["productivity_raw"] = oracle.productivity_raw_sql(MONTH)
    out["hourly_report"] = oracle.hourly_report_sql(MONTH)
    out["daily_report"] = oracle.daily_report_sql(MONTH)
    out["grc_report"] = oracle.grc_sql(MONTH)
    for key, (_, sql) in catalog.build(MONTH).items():
        out[key] = sql
    out["param_report"] = oracle.report_sql("report_picking", MONTH)
    out["sink_csv"] = oracle.report_sql("report_picking", MONTH)
    out["sink_append"] = oracle.sink_append_sql(MONTH)
    out["high_watermark"] = oracle.high_watermark_sql(MONTH)
    out["next_window"] = oracle.next_window_sql(MONTH, AFTER_MONTH)
    out["incremental_run"] = oracle.incremental_sql(*_run_bounds())
    out["incremental_committed"] = oracle.incremental_sql(*_run_bounds())
    out["daily_from_hourly"] = oracle.daily_report_sql(MONTH)
    out["working_seconds_segments"] = oracle.window_seconds_sql(PICKING.modules, PART_DAYS)
    out["late_hours"] = oracle.late_hours_sql(MONTH, LATE_WAREHOUSE)
    out["catch_up"] = oracle.catch_up_sql(MONTH)
    out["overlap_windows"] = oracle.overlap_windows_sql(TASK_WINDOWS)
    out["semi_join_bucketed"] = catalog.build(MONTH)["task_semi_join"][1]
    out["sink_report_files"] = oracle.report_sql("report_picking", MONTH)
    out["stream_hourly_users"] = oracle.stream_users_sql(MONTH)
    out["stream_hourly_items"] = oracle.stream_items_sql(MONTH)
    out["stream_hourly_time"] = oracle.hourly_time_sql(MONTH)
    out["stream_pick_time"] = catalog.build(MONTH)["pick_time_join"][1]
    out["stream_hourly_job"] = oracle.incremental_sql(LOG_DAYS, [])
    return out
