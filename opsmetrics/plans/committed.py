"""Incremental hourly load whose raw, daily and hourly tables change in one commit.

The same load as ``incremental.run_increment``, over ``sources.snapshots``:
each run writes new folders for the days its window touches and then one
commit file names them, so a run that fails anywhere leaves the tables as
they were and readers never see a daily table that is ahead of the hourly
one.  The high-water mark is a note of the commit; no table is read
for it.

* ``upsert``: the window's hours replace the same hours, and the rows of
  every day that the window touches are worked out anew from that day's raw rows.
* ``append``: each run adds its own daily and hourly rows, as the source
  does; they are kept under the run's window, so a run that is repeated
  after its commit adds nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.windows import FMT, ReportWindow, next_window, ts_lit
from ..sources.snapshots import Snapshot, Snapshots
from .hourly import daily_report, hourly_pipeline, hourly_report

TABLES = ("raw", "daily", "hourly")


def _days(window: ReportWindow) -> list[str]:
    n = (window.end.date() - window.start.date()).days
    return [str(window.start.date() + dt.timedelta(days=i)) for i in range(n + 1)]


def mark_of(snapshot: Snapshot) -> dt.datetime | None:
    """The last loaded hour."""
    text = snapshot.notes.get("mark")
    return dt.datetime.strptime(text, FMT) if text else None


def run_committed(
    spark: SparkSession,
    roles,
    target: str,
    now: dt.datetime,
    mode: str = "upsert",
    bootstrap: dt.datetime | None = None,
    fix_labels: bool = False,
    keep: int = 2,
) -> ReportWindow | None:
    """One hourly run: the window after the mark, loaded and committed; None if there is nothing new."""
    window = next_window(mark_of(Snapshots(spark, target).head()), now, bootstrap)
    if window is None:
        return None
    load_committed(spark, roles, target, window, mode, fix_labels, keep)
    return window


def load_committed(spark: SparkSession, roles, target: str, window: ReportWindow, mode: str = "upsert", fix_labels: bool = False, keep: int = 2) -> Snapshot:
    """Load one window and commit its raw, daily and hourly rows together."""
    if mode not in ("append", "upsert"):
        raise ValueError(mode)
    store = Snapshots(spark, target)
    head = store.head()
    run = f"{window.start_text} - {window.end_text}"
    if mode == "append" and run in head.keys("hourly"):
        return head
    fresh = hourly_pipeline(roles, window, fix_labels=fix_labels).withColumn("date", F.to_date("timestamp"))
    days, merged = _days(window), fresh
    held = [d for d in days if d in head.keys("raw")]
    if held:
        inside = F.col("timestamp").between(ts_lit(window.start), ts_lit(window.end))
        merged = fresh.unionByName(store.read("raw", head, held).where(~inside).select(*fresh.columns))
    written = {"raw": store.write(merged, "raw", by="date")}
    parts, schema = written["raw"]
    raw = store.folders(Snapshot(schemas={"raw": schema}), "raw", list(parts.values()))  # what was just written, not the plan again
    if mode == "append":
        hours = raw.where(F.col("timestamp").between(ts_lit(window.start), ts_lit(window.end)))
        written["daily"] = store.write(daily_report(hours), "daily", key=run)
        written["hourly"] = store.write(hourly_report(hours), "hourly", key=run)
        drop = {"raw": days}
    else:
        written["daily"] = store.write(daily_report(raw), "daily", by="date")
        written["hourly"] = store.write(hourly_report(raw).withColumn("date", F.to_date("timestamp")), "hourly", by="date")
        drop = {t: days for t in TABLES}  # days without rows any more go
    mark = _newest(raw)
    known = mark_of(head)
    mark = max((m for m in (mark, known) if m is not None), default=None)
    made = store.commit(head, written, drop=drop, notes={"mark": mark and mark.strftime(FMT)})
    store.vacuum(keep)
    return made


def _newest(raw: DataFrame) -> dt.datetime | None:
    return raw.agg(F.max("timestamp").alias("t")).first()["t"]
