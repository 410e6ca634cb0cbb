"""Report windows and the time predicates built on them.

A ``ReportWindow`` holds the two literal bounds S and E of a report.  The
reports use three different bound rules on purpose (open, half-open,
closed) and a four-way interval-overlap test on tasks; each is a plain
Column expression so Catalyst can push it into the Parquet scan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name of the partition column of tables that are stored by day.
DAY = "stamp_day"
FMT = "%Y-%m-%d %H:%M:%S"


def _parse(v: str | dt.datetime) -> dt.datetime:
    if isinstance(v, dt.datetime):
        return v
    v = v.strip()
    for fmt in (FMT, "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d"):
        try:
            return dt.datetime.strptime(v, fmt)
        except ValueError:
            pass
    raise ValueError(f"not a timestamp: {v!r}")


@dataclass(frozen=True)
class ReportWindow:
    """Inclusive literal bounds [start, end] of a report (zone-less timestamps)."""

    start: dt.datetime
    end: dt.datetime

    @classmethod
    def of(cls, start: str | dt.datetime, end: str | dt.datetime) -> "ReportWindow":
        return cls(_parse(start), _parse(end))

    @property
    def start_text(self) -> str:
        return self.start.strftime(FMT)

    @property
    def end_text(self) -> str:
        return self.end.strftime(FMT)

    @property
    def length_micros(self) -> int:
        d = self.end - self.start
        return (d.days * 86400 + d.seconds) * 1_000_000 + d.microseconds

    @property
    def is_empty(self) -> bool:
        return self.start > self.end

    def s(self) -> Column:
        return ts_lit(self.start)

    def e(self) -> Column:
        return ts_lit(self.end)


def ts_lit(v: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal (the source data carries no zone).

    Built from text: a Python datetime literal would pass through the
    driver's and the session's time zones.
    """
    return F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz")


def in_window(col: str | Column, window: ReportWindow, bounds: str = "open") -> Column:
    """Window test on one timestamp column.

    ``open``: S < ts < E (item reports); ``half_open``: S <= ts < E (hourly
    feed); ``closed``: S <= ts <= E (work log, receipts).
    """
    c = F.col(col) if isinstance(col, str) else col
    s, e = window.s(), window.e()
    if bounds == "open":
        return (c > s) & (c < e)
    if bounds == "half_open":
        return (c >= s) & (c < e)
    if bounds == "closed":
        return c.between(s, e)
    raise ValueError(f"unknown bounds {bounds!r}")


def of_days(df: DataFrame, window: ReportWindow) -> DataFrame:
    """Rows of the window's days, where the table is partitioned by day: a partition filter, so other days are not listed or opened.

    The stamp's own test still decides; rows without a stamp lie in no
    day and pass no window either.
    """
    if DAY not in df.columns:
        return df
    return df.where(F.col(DAY).between(F.lit(window.start.date()), F.lit(window.end.date()))).drop(DAY)


def overlaps(start: str | Column, end: str | Column, window: ReportWindow) -> Column:
    """The task-overlap test as four ORed BETWEENs.

    Kept literally rather than as ``start <= E AND end >= S``: with a NULL
    end only "start in window" can be true, and a reversed task
    (start > end) is kept when either of its ends lies in the window.
    """
    a = F.col(start) if isinstance(start, str) else start
    b = F.col(end) if isinstance(end, str) else end
    s, e = window.s(), window.e()
    return a.between(s, e) | b.between(s, e) | s.between(a, b) | e.between(a, b)


def micros_since(col: str | Column, origin: Column) -> Column:
    """Exact microseconds from ``origin`` to ``col`` (bigint, may be negative)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("MICROSECOND", origin, c)


def hour_bucket(col: str | Column) -> Column:
    """Timestamp with minute, second and fraction set to zero, kept zone-less.

    Built from the wall-clock fields, so no session time zone (or its
    daylight-saving gaps) is involved.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0))


EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_to_instant(col: str | Column) -> Column:
    """Zone-less wall time -> TIMESTAMP instant with the same UTC wall time (zone-independent)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), c))


def instant_to_ntz(col: str | Column) -> Column:
    """Inverse of ``ntz_to_instant``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def next_window(mark: dt.datetime | None, now: dt.datetime, bootstrap: dt.datetime | None = None):
    """Window of the next hourly run from the high-water mark.

    S = mark + 1 hour (the mark is the last loaded hour bucket), E = now
    truncated to the hour minus one second.  With no mark an explicit
    ``bootstrap`` start is required.  Returns None when S is after E
    (nothing new to load yet).
    """
    if mark is None:
        if bootstrap is None:
            raise ValueError("results table is empty: pass a bootstrap start")
        start = _parse(bootstrap)
    else:
        start = _parse(mark) + dt.timedelta(hours=1)
    end = now.replace(minute=0, second=0, microsecond=0) - dt.timedelta(seconds=1)
    w = ReportWindow(start, end)
    return None if w.is_empty else w
