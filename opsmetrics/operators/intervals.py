"""Joins against a table of report windows, by day buckets.

A window table has a row for each window: ``window_start`` and
``window_end`` (zone-less).  Rows meet windows through the days that both
touch, so the join has an equality key and is planned as a hash or
sort-merge join, never as a nested loop; the exact test follows.  A stamp lies in one day, so each
pair is made once.  A task and a window may share many days: the pair
belongs to the first of them.  Only the window side is ever collected for
a broadcast, and only while it has few rows; the rows that meet it grow
with the data, and exploded into days they are many times their stored size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.windows import DAY, ReportWindow

START, END = "window_start", "window_end"
WINDOW_KEYS = (START, END)
_DAY, _LO, _HI = "_day", "_lo", "_hi"
# Window tables of at most so many rows by day are sent to every task; larger ones are merged with the rows.
SMALL = 100_000


def hour_windows(spark: SparkSession, window: ReportWindow) -> DataFrame:
    """The windows of the hourly runs that make up ``window``: each from a full hour to one second before the next."""
    one = spark.range(1).select(F.explode(F.sequence(window.s(), window.e(), F.expr("INTERVAL 1 HOUR"))).alias(START))
    return one.select(START, (F.col(START) + F.expr("INTERVAL '59:59' MINUTE TO SECOND")).alias(END))


def span_of(windows: DataFrame) -> ReportWindow | None:
    """From the first start to the last end (None for an empty table)."""
    lo, hi = windows.where(F.col(START) <= F.col(END)).agg(F.min(START), F.max(END)).first()
    return None if lo is None else ReportWindow(lo, hi)


def by_day(windows: DataFrame) -> DataFrame:
    """A row for each window and day it touches; repeated windows count once, those that end before they start touch none."""
    days = F.sequence(F.to_date(START), F.to_date(END))
    return windows.select(*WINDOW_KEYS).where(F.col(START) <= F.col(END)).distinct().withColumn(_DAY, F.explode(days))


def meet(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """``rows``, which have a day, with the windows that touch it; ``rows`` are never collected, whatever size Spark takes them for."""
    days = by_day(windows)
    return rows.join(days.hint("broadcast" if days.count() <= SMALL else "merge"), _DAY)


def stamps_in_windows(rows: DataFrame, stamp: str, windows: DataFrame, bounds: str = "closed") -> DataFrame:
    """Rows with each window their stamp lies in; ``bounds`` as in ``functions.windows.in_window``.

    Where the table is stored by day, the windows' span becomes a partition filter.
    """
    span = span_of(windows)
    if DAY in rows.columns:
        held = F.lit(False) if span is None else F.col(DAY).between(F.lit(span.start.date()), F.lit(span.end.date()))
        rows = rows.where(held).drop(DAY)
    t, s, e = F.col(stamp), F.col(START), F.col(END)
    test = {"closed": (t >= s) & (t <= e), "half_open": (t >= s) & (t < e), "open": (t > s) & (t < e)}[bounds]
    return meet(rows.withColumn(_DAY, F.to_date(stamp)), windows).where(test).drop(_DAY)


def in_either(start: str, end: str):
    """The four-way overlap test against the window of the same row (``functions.windows.overlaps`` with columns for bounds)."""
    a, b, s, e = F.col(start), F.col(end), F.col(START), F.col(END)
    return a.between(s, e) | b.between(s, e) | s.between(a, b) | e.between(a, b)


def overlapping_windows(tasks: DataFrame, windows: DataFrame, start: str = "startdate", end: str = "enddate") -> DataFrame:
    """Tasks with each window they overlap, one row for each pair.

    A task's days run from its earlier to its later bound (a reversed task
    can only match by one of its bounds, a task with one bound by that),
    cut to the windows' span, so a task that is open for years costs no
    more days than the windows have.  A pair that meets on several days is
    kept on the later of its two first days.
    """
    span = span_of(windows)
    if span is None:
        return tasks.crossJoin(windows.select(*WINDOW_KEYS).limit(0))
    lo, hi = F.least(start, end), F.greatest(start, end)  # both skip a NULL bound
    t = tasks.withColumns({_LO: F.greatest(F.to_date(lo), F.lit(span.start.date())), _HI: F.least(F.to_date(hi), F.lit(span.end.date()))})
    t = t.where(lo.isNotNull() & (F.col(_LO) <= F.col(_HI))).withColumn(_DAY, F.explode(F.sequence(_LO, _HI)))
    owner = F.col(_DAY) == F.greatest(F.col(_LO), F.to_date(START))
    return meet(t, windows).where(owner & in_either(start, end)).drop(_DAY, _LO, _HI)
