"""Incremental hourly load driven by a high-water mark.

One run: read the last loaded hour from the hourly results table, derive
the next window [mark + 1 h, now truncated to the hour - 1 s], build the
worker-hour rows for it, then load the daily and the hourly table.

Two load modes:

* ``append`` (as the source does): each run appends its daily and hourly
  rows.  A day spread over several runs gets one partial daily row per
  run, and a failed run between the two appends leaves the tables out of
  step.
* ``upsert`` (idempotent): worker-hour rows are stored in a ``raw`` table
  partitioned by date; the window's hours replace the same hours there,
  and the daily and hourly rows of every date the window touches are
  recomputed from all raw rows of that date and replace those date
  partitions.  Re-running a window, or running after a failure, converges
  to the same tables.

The merged raw rows are written to a staging table in the shared
checkpoint folder before anything else reads them, which also cuts the
lineage: the roll-ups and the partition overwrite read that table, not the
recomputed plan or the files being replaced.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.windows import ReportWindow, next_window, ts_lit
from ..session import checkpoint_dir
from ..sources.sinks import append, clear_partitions, high_watermark, overwrite_partitions, table_exists
from .hourly import daily_report, hourly_pipeline, hourly_report


def next_window_frame(results: DataFrame, now: dt.datetime, bootstrap: dt.datetime | None = None) -> DataFrame:
    """The next window as a one-row DataFrame (no row when there is nothing new).

    ``start_date`` = last hour bucket + 1 hour (or ``bootstrap`` when the
    table is empty), ``end_date`` = ``now`` truncated to the hour minus one second.
    """
    end = now.replace(minute=0, second=0, microsecond=0) - dt.timedelta(seconds=1)
    mark = high_watermark(results)
    start = F.col("max_timestamp") + F.expr("INTERVAL 1 HOUR")
    if bootstrap is not None:
        start = F.coalesce(start, ts_lit(bootstrap))
    return mark.select(start.alias("start_date"), ts_lit(end).alias("end_date")).where(
        F.col("start_date") <= F.col("end_date")
    )


def run_increment(
    spark: SparkSession,
    roles,
    target: str,
    now: dt.datetime,
    mode: str = "upsert",
    bootstrap: dt.datetime | None = None,
    fix_labels: bool = False,
) -> ReportWindow | None:
    """One hourly run into ``{target}/{raw,daily,hourly}``; returns the window loaded (None: nothing to do)."""
    if mode not in ("append", "upsert"):
        raise ValueError(mode)
    base = target.rstrip("/")
    raw_path, daily_path, hourly_path = f"{base}/raw", f"{base}/daily", f"{base}/hourly"
    mark = None
    if table_exists(spark, hourly_path):
        mark = high_watermark(spark.read.parquet(hourly_path)).first()[0]  # one scalar
    window = next_window(mark, now, bootstrap)
    if window is None:
        return None
    return run_window(spark, roles, base, window, mode, fix_labels)


def run_window(
    spark: SparkSession,
    roles,
    target: str,
    window: ReportWindow,
    mode: str = "upsert",
    fix_labels: bool = False,
) -> ReportWindow:
    """Load one explicit window into ``{target}/{raw,daily,hourly}`` (see the module notes for the modes).

    The raw table is partitioned by date.  The window's worker-hour rows
    replace the stored rows of the same hours; the other stored hours of
    the touched dates are kept.  The merged rows of those dates are
    written to a staging table in the shared checkpoint folder before they
    overwrite their partitions, so the write never reads the files it
    replaces and nothing downstream recomputes the pipeline.  Stored dates
    of the window that have no rows any more are emptied in all three
    tables.  The staging table has one name for each target and is
    emptied after the last write.
    """
    base = target.rstrip("/")
    raw_path, daily_path, hourly_path = f"{base}/raw", f"{base}/daily", f"{base}/hourly"
    fresh = hourly_pipeline(roles, window, fix_labels=fix_labels).withColumn("date", F.to_date("timestamp"))
    merged = fresh
    touched = F.col("date").between(F.lit(window.start.date()), F.lit(window.end.date()))
    if table_exists(spark, raw_path):
        in_window = F.col("timestamp").between(ts_lit(window.start), ts_lit(window.end))
        kept = spark.read.parquet(raw_path).where(touched & ~in_window)
        merged = fresh.unionByName(kept.select(*fresh.columns))
    # Written once to the shared folder: a Dataset checkpoint would compute the plan twice.
    stage = f"{checkpoint_dir(spark).rstrip('/')}/raw-stage-{hashlib.md5(base.encode()).hexdigest()}"
    schema = merged.schema
    merged.write.mode("overwrite").parquet(stage)
    merged = spark.read.schema(schema).parquet(stage)
    # Days of the window that any of the tables still holds, though no row is left: at most one row a day.
    dated = [raw_path] if mode == "append" else [raw_path, daily_path, hourly_path]
    held = [spark.read.parquet(p).where(touched).select("date") for p in dated if table_exists(spark, p)]
    gone = []
    if held:
        days = reduce(DataFrame.union, held).distinct()
        gone = [r["date"] for r in days.join(merged.select("date").distinct(), "date", "left_anti").collect()]
    overwrite_partitions(merged, raw_path, ("date",))
    clear_partitions(spark, raw_path, schema, "date", gone)

    if mode == "append":
        hours = merged.where(F.col("timestamp").between(ts_lit(window.start), ts_lit(window.end)))
        append(daily_report(hours), daily_path)
        append(hourly_report(hours), hourly_path)
    else:
        daily = daily_report(merged)
        hourly = hourly_report(merged).withColumn("date", F.to_date("timestamp"))
        overwrite_partitions(daily, daily_path, ("date",))
        overwrite_partitions(hourly, hourly_path, ("date",))
        clear_partitions(spark, daily_path, daily.schema, "date", gone)
        clear_partitions(spark, hourly_path, hourly.schema, "date", gone)
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(stage)
    return window
