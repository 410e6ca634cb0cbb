"""Late rows: hours whose source rows have changed since they were loaded, found by digests.

The load keeps, for every hour and source table, the number of rows and a
sum of row hashes of what it read.  The same digest of the source as it is
now shows, hour by hour, where rows have come, gone or changed; only these hours
are loaded again.  Digests are sums, so they need one aggregation with
partial sums and no order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.windows import ReportWindow, hour_bucket, in_window, of_days
from ..sources.snapshots import Snapshot, Snapshots
from .committed import load_committed

SOURCES = {"items": "lastmodifieddate", "worklog": "actiontime"}
_HOUR = dt.timedelta(hours=1)


def hour_digests(roles, window: ReportWindow) -> DataFrame:
    """timestamp, source, n_rows, digest of the window's rows of both hourly sources."""
    found = None
    for source, stamp in SOURCES.items():
        rows = of_days(getattr(roles, source), window)
        rows = rows.where(in_window(stamp, window, "closed"))
        # Modulo 2**52, so that no sum of hashes overflows.
        mark = F.sum(F.pmod(F.xxhash64(*sorted(rows.columns)), F.lit(1 << 52)).cast("decimal(38,0)"))
        one = rows.groupBy(hour_bucket(stamp).alias("timestamp")).agg(F.count(F.lit(1)).alias("n_rows"), mark.alias("digest"))
        one = one.select("timestamp", F.lit(source).alias("source"), "n_rows", "digest")
        found = one if found is None else found.unionByName(one)
    return found


def late_hours(loaded: DataFrame, now: DataFrame) -> DataFrame:
    """timestamp, source, n_loaded, n_source of the hours whose digests differ."""
    a, b = loaded.alias("a"), now.alias("b")
    same = (F.col("a.timestamp") == F.col("b.timestamp")) & (F.col("a.source") == F.col("b.source"))
    differ = ~F.col("a.n_rows").eqNullSafe(F.col("b.n_rows")) | ~F.col("a.digest").eqNullSafe(F.col("b.digest"))
    n = lambda side: F.coalesce(f"{side}.n_rows", F.lit(0)).cast("long")
    return a.join(b, same, "full").where(differ).select(
        F.coalesce("a.timestamp", "b.timestamp").alias("timestamp"), F.coalesce("a.source", "b.source").alias("source"),
        n("a").alias("n_loaded"), n("b").alias("n_source"))


def _windows(hours: list[dt.datetime]) -> list[ReportWindow]:
    return [ReportWindow(h, h + _HOUR - dt.timedelta(seconds=1)) for h in sorted(set(hours))]


def _to_the_last(window: ReportWindow) -> ReportWindow:
    """The window up to the last microsecond of its last second."""
    return ReportWindow(window.start, window.end.replace(microsecond=999_999))


def load_with_digests(spark: SparkSession, roles, target: str, window: ReportWindow) -> Snapshot:
    """``load_committed`` (upsert), then the digests of what was loaded, kept by day in a commit of their own.

    A failure between the two leaves old digests, so the hours show up
    as late and are loaded again: nothing is lost.
    """
    digests = hour_digests(roles, _to_the_last(window)).withColumn("date", F.to_date("timestamp"))
    load_committed(spark, roles, target, window)
    store = Snapshots(spark, target)
    head = store.head()
    days = [str(window.start.date() + dt.timedelta(days=i)) for i in range((window.end.date() - window.start.date()).days + 1)]
    held = [d for d in days if d in head.keys("digests")]
    if held:
        digests = digests.unionByName(store.read("digests", head, held).where(~in_window("timestamp", window, "closed")))
    return store.commit(head, {"digests": store.write(digests, "digests", by="date")}, drop={"digests": days})


def repair(spark: SparkSession, roles, target: str, window: ReportWindow) -> list[ReportWindow]:
    """Load again exactly the hours of ``window`` whose source rows differ from the loaded ones."""
    store = Snapshots(spark, target)
    loaded = store.read("digests")
    if loaded is None:
        load_with_digests(spark, roles, target, window)
        return [window]
    loaded = loaded.where(in_window("timestamp", window, "closed")).drop("date")
    found = late_hours(loaded, hour_digests(roles, _to_the_last(window))).select("timestamp").distinct().collect()  # at most the window's hours
    again = _windows([r["timestamp"] for r in found])
    for hour in again:
        load_with_digests(spark, roles, target, hour)
    return again
