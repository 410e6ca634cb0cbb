"""Working time from stored segments: one record per worker and day that can be put together for any window.

A segment stands for a stretch of a worker's log in log-id order: its
first and last status, the stamp of its first row, and the signed stamps of
the status changes after the first row.  Whether the first row is a change
depends only on the last status before it, so two neighbouring segments
make one (``combined``), in any grouping: the operation is associative.

``window_time`` takes the stored segments of a window's inner days and
works out only its two edge days from the log.  Workers whose days are not in log-id
order (a late row with an early id, or rows without an id) cannot be put together by
days; they are found by their id ranges and worked out from the log.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import exact_sum, micros_to_interval, micros_to_seconds
from ..functions.windows import EPOCH_NTZ, ReportWindow, in_window, micros_since, of_days
from ..spec import STATUS_IN, STATUS_OUT
from .sessions import DEFAULT_BLOCK, previous_in_order, session_changes, working_time

WORKER = ("warehouse", "emailaddress")
RECORD = ("lo", "hi", "no_id", "first_status", "first_us", "last_status", "n_in", "n_out", "in_us", "out_us")


def _epoch_us(col: str = "actiontime") -> Column:
    return micros_since(col, F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def day_segments(worklog: DataFrame, modules: Iterable[str], block: int = DEFAULT_BLOCK) -> DataFrame:
    """One record per warehouse, worker and day of the log's in and out rows of the modules."""
    log = worklog.where(F.col("status").isin(STATUS_IN, STATUS_OUT) & F.col("modulename").isin(*modules) & F.col("actiontime").isNotNull())
    log = log.select(*WORKER, "logid", "modulename", "status", "actiontime", F.to_date("actiontime").alias("day"))
    log = previous_in_order(log, [*WORKER, "day"], "logid", "status", "before", block)
    us, opens = _epoch_us(), F.col("before").isNull()
    turn = ~opens & (F.col("status") != F.col("before"))
    side = lambda s: turn & (F.col("status") == s)
    return log.groupBy(*WORKER, "day").agg(
        F.min("logid").alias("lo"), F.max("logid").alias("hi"), F.count_if(F.col("logid").isNull()).alias("no_id"),
        F.max(F.when(opens, F.col("status"))).alias("first_status"), F.max(F.when(opens, us)).alias("first_us"),
        F.max_by("status", F.struct("logid", "modulename", "status", "actiontime")).alias("last_status"),
        F.count_if(side(STATUS_IN)).alias("n_in"), F.count_if(side(STATUS_OUT)).alias("n_out"),
        exact_sum(F.when(side(STATUS_IN), us).otherwise(0)).alias("in_us"), exact_sum(F.when(side(STATUS_OUT), us).otherwise(0)).alias("out_us"),
    )


def combined(segments: DataFrame, keys: Iterable[str] = WORKER) -> DataFrame:
    """Segments of each key as one, with ``mixed``: whether their id ranges overlap, so that days cannot be put together.

    A window per key over one row for each of its segments.
    """
    keys = list(keys)
    inside = Window.partitionBy(*keys).orderBy(F.col("lo").asc_nulls_last(), F.col("hi"), "day")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    s = segments.withColumns({"_last": F.lag("last_status").over(inside), "_hi": F.max("hi").over(before), "_nth": F.row_number().over(inside)})
    turns = (F.col("_nth") > 1) & ~F.col("first_status").eqNullSafe(F.col("_last"))
    at = lambda side: turns & (F.col("first_status") == side)
    one = lambda side: F.when(at(side), 1).otherwise(0)
    first_us = lambda side: F.when(at(side), F.col("first_us")).otherwise(0)
    s = s.withColumns({
        "n_in": F.col("n_in") + one(STATUS_IN), "n_out": F.col("n_out") + one(STATUS_OUT),
        "in_us": F.col("in_us") + first_us(STATUS_IN), "out_us": F.col("out_us") + first_us(STATUS_OUT),
    })
    whole = F.struct("_nth")
    return s.groupBy(*keys).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("no_id").alias("no_id"),
        F.min_by("first_status", whole).alias("first_status"), F.min_by("first_us", whole).alias("first_us"), F.max_by("last_status", whole).alias("last_status"),
        F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out"), exact_sum(F.col("in_us")).alias("in_us"), exact_sum(F.col("out_us")).alias("out_us"),
        F.min("day").alias("day"),
        (F.max(F.coalesce(F.col("lo") <= F.col("_hi"), F.lit(False))) | ((F.sum("no_id") > 0) & (F.count(F.lit(1)) > 1))).alias("mixed"),
    )


def segment_time(segments: DataFrame, window: ReportWindow) -> DataFrame:
    """``sessions.working_time`` from combined segments: the first row counts as a change."""
    start = micros_since(window.s(), F.lit(EPOCH_NTZ).cast("timestamp_ntz")).cast("decimal(38,0)")
    opens = lambda side: F.when(F.col("first_status") == side, 1).otherwise(0)
    first = lambda side: F.when(F.col("first_status") == side, F.col("first_us")).otherwise(0)
    n_in, n_out = F.col("n_in") + opens(STATUS_IN), F.col("n_out") + opens(STATUS_OUT)
    us = (F.col("out_us") + first(STATUS_OUT) - start * n_out) - (F.col("in_us") + first(STATUS_IN) - start * n_in)
    us = F.when((n_in > 0) & (n_out > 0), us)  # a side without rows makes the time unknown
    total = F.when(us < 0, us + F.lit(window.length_micros)).otherwise(us).cast("decimal(38,0)")
    return segments.select(
        *WORKER, total.alias("total_working_us"), micros_to_seconds(total).alias("total_working_seconds"), micros_to_interval(total).alias("total_working_hrs"))


def window_time(stored: DataFrame, worklog: DataFrame, modules: Iterable[str], window: ReportWindow, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Working time of a window from the stored day segments of its inner days and the log of its two edge days."""
    modules = list(modules)
    first, last = window.start.date(), window.end.date()
    inner = stored.where((F.col("day") > F.lit(first)) & (F.col("day") < F.lit(last)))
    edges = None
    for day in sorted({first, last}):
        whole = ReportWindow(max(window.start, dt.datetime.combine(day, dt.time())), min(window.end, dt.datetime.combine(day, dt.time.max)))
        log = of_days(worklog, whole).where(in_window("actiontime", whole, "closed"))
        edges = log if edges is None else edges.unionByName(log)
    made = combined(inner.unionByName(day_segments(edges, modules, block).select(*inner.columns)))
    time = segment_time(made.where(~F.col("mixed")), window)
    mixed = made.where("mixed").select(*WORKER)
    if mixed.isEmpty():
        return time
    names = mixed.withColumnsRenamed({c: f"of_{c}" for c in WORKER})
    same = worklog["warehouse"].eqNullSafe(names["of_warehouse"]) & worklog["emailaddress"].eqNullSafe(names["of_emailaddress"])
    rest = working_time(session_changes(worklog.join(names, same, "left_semi"), modules, window, block=block), window)
    return time.unionByName(rest)
