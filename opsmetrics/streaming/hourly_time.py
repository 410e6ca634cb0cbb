"""Working time per hour and worker as a stream, with each worker's last status carried between batches.

The hourly working time needs every log row's predecessor: the worker's row
before it in log-id order, over all processes.  A micro-batch has only its
own rows, so the stream keeps, in tables that are committed together
(``sources.snapshots``):

* ``edges``: each worker's last settled status and log id,
* ``waiting``: rows that may still be preceded by rows to come,
* ``turns``: signed sums of the settled status changes per warehouse, process,
  hour and worker, one part for each batch,
* ``late``: rows that came after a later row of their worker had settled.

A row settles when its stamp is ``delay`` or more behind the newest stamp seen, and every row of its
worker with a smaller log id settles with it or before; so rows may come out of order within the
delay.  Settled rows get their predecessor in their batch, the first of a
worker from the edge.  ``hourly_time_so_far`` adds what the waiting rows give
after the edges, so the result always covers every row that has come, but the
late ones, which stay in their table: ``late_days`` names the days that
the batch job should load again.

A batch is committed with its number; one that is replayed after a failure
finds its number there and changes nothing.  The edges follow the number of
workers, the waiting rows the delay; the log is never read again.  Parts of ``turns`` are added up
when there are ``COMPACT`` of them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import classify_module
from ..functions.measures import exact_sum
from ..functions.windows import ReportWindow, hour_bucket, micros_since, ts_lit
from ..operators.sessions import DEFAULT_BLOCK, corrected_hours, log_filter, previous_in_order
from ..sources.roles import ROLE_SCHEMAS
from ..sources.snapshots import Snapshot, Snapshots
from ..spec import STATUS_IN, STATUS_OUT, all_modules

LOG = ("warehouse", "emailaddress", "logid", "modulename", "status", "actiontime")
WORKER = ("warehouse", "emailaddress")
KEYS = ("warehouse", "process", "timestamp", "emailaddress")
COMPACT = 24  # parts of ``turns``


def _same(a: DataFrame, b: DataFrame) -> Column:
    """Both rows are of one worker (a warehouse may be unknown)."""
    return a["warehouse"].eqNullSafe(b["of_warehouse"]) & (a["emailaddress"] == b["of_emailaddress"])


def _of(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: f"of_{c}" for c in WORKER})


def _turns(rows: DataFrame, edges: DataFrame | None, block: int) -> DataFrame:
    """Signed microseconds of the status changes in ``rows``, each worker's first row compared with its edge."""
    log = rows.select(*LOG, F.lit(False).alias("carried"))
    if edges is not None:
        touched = _of(rows.select(*WORKER).distinct())
        carried = edges.join(touched, _same(edges, touched), "left_semi").select(
            *WORKER, "logid", F.lit(None).cast("string").alias("modulename"), "status",
            F.lit(None).cast("timestamp_ntz").alias("actiontime"), F.lit(True).alias("carried"))
        log = log.unionByName(carried)
    before = previous_in_order(log, list(WORKER), "logid", "status", "prev_to", block)
    changes = before.where(~F.col("carried") & ~F.col("status").eqNullSafe(F.col("prev_to")))
    hour = hour_bucket("actiontime")
    us = micros_since("actiontime", hour)
    signed = F.when(F.col("status") == STATUS_OUT, us).when(F.col("status") == STATUS_IN, -us)
    named = changes.withColumns({"process": classify_module("modulename"), "timestamp": hour, "_signed": signed})
    return named.groupBy(*KEYS).agg(exact_sum(F.col("_signed")).alias("us"))


def settle(store: Snapshots, batch: DataFrame, number: int, window: ReportWindow, delay: dt.timedelta, block: int = DEFAULT_BLOCK) -> Snapshot:
    """Take one micro-batch of work-log rows into the tables and commit them."""
    head = store.head()
    if head.notes.get("batch", -1) >= number:
        return head
    log = log_filter(batch, all_modules(), window).where("emailaddress is not null").select(*LOG)
    waiting, edges = store.read("waiting", head), store.read("edges", head)
    if waiting is not None:
        log = log.unionByName(waiting)
    # Written once: the steps below read it several times.
    arrived, schema = store.write(log, "arrived")
    log = store.folders(Snapshot(schemas={"arrived": schema}), "arrived", list(arrived.values()))
    newest = log.agg(F.max("actiontime").alias("t")).first()["t"]
    known = head.notes.get("newest")
    newest = max((t for t in (newest, known and dt.datetime.strptime(known, "%Y-%m-%d %H:%M:%S.%f")) if t), default=None)
    if newest is None:
        return store.commit(head, {}, notes={"batch": number})
    horizon = ts_lit(newest - delay)

    young = _of(log.where(F.col("actiontime") > horizon).groupBy(*WORKER).agg(F.min("logid").alias("hold")))
    rows = log.join(young, _same(log, young), "left").drop("of_warehouse", "of_emailaddress")
    if edges is not None:
        at = _of(edges.select(*WORKER, F.col("logid").alias("done")))
        rows = rows.join(at, _same(rows, at), "left").drop("of_warehouse", "of_emailaddress")
    else:
        rows = rows.withColumn("done", F.lit(None).cast("long"))
    late = F.coalesce(F.col("logid") <= F.col("done"), F.lit(False))
    ready = F.col("logid").isNotNull() & (F.col("actiontime") <= horizon) & F.coalesce(F.col("logid") < F.col("hold"), F.lit(True))
    settled = rows.where(~late & ready).select(*LOG)

    last = F.struct("logid", "modulename", "status", "actiontime")
    ends = settled.groupBy(*WORKER).agg(F.max(last).alias("end")).select(*WORKER, "end.logid", "end.status")
    if edges is not None:
        ends = edges.unionByName(ends).groupBy(*WORKER).agg(F.max(F.struct("logid", "status")).alias("end")).select(*WORKER, "end.logid", "end.status")
    written = {
        "turns": store.write(_turns(settled, edges, block), "turns", key=f"{number:012d}"),
        "edges": store.write(ends, "edges"),
        "waiting": store.write(rows.where(~late & ~ready).select(*LOG), "waiting"),
        "late": store.write(rows.where(late).select(*LOG), "late", key=f"{number:012d}"),
    }
    made = store.commit(head, written, notes={"batch": number, "newest": newest.strftime("%Y-%m-%d %H:%M:%S.%f")})
    if len(made.tables["turns"]) >= COMPACT:
        made = compact(store, made)
    store.vacuum()
    return made


def compact(store: Snapshots, at: Snapshot) -> Snapshot:
    """The parts of ``turns`` added up, and those of ``late`` put together, in one commit."""
    turns = store.read("turns", at).groupBy(*KEYS).agg(exact_sum(F.col("us")).alias("us"))
    key = max(at.keys("turns"))
    written = {"turns": store.write(turns, "turns", key=key), "late": store.write(store.read("late", at), "late", key=key)}
    return store.commit(at, written, replace=("turns", "late"))


def hourly_time_so_far(spark: SparkSession, target: str, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Hourly working time over all rows that have come but the late ones; columns of ``sessions.hourly_working_time``."""
    store = Snapshots(spark, target)
    head = store.head()
    if "turns" not in head.tables:
        return spark.createDataFrame([], "warehouse string, process string, timestamp timestamp_ntz, emailaddress string, working_us decimal(38,0), working_sec double")
    ahead = _turns(store.read("waiting", head), store.read("edges", head), block)
    every = store.read("turns", head).unionByName(ahead).groupBy(*KEYS).agg(exact_sum(F.col("us")).alias("_us"))
    return corrected_hours(every)


def late_days(spark: SparkSession, target: str) -> DataFrame:
    """day, n_rows: days whose late rows the stream has left out."""
    late = Snapshots(spark, target).read("late")
    if late is None:
        return spark.createDataFrame([], "day date, n_rows long")
    return late.groupBy(F.to_date("actiontime").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))


def run_available(spark: SparkSession, landing: str, target: str, checkpoint: str, window: ReportWindow,
                  delay: dt.timedelta = dt.timedelta(hours=1), max_files_per_trigger: int | None = None, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Process all log files in ``landing`` that the checkpoint has not seen (availableNow); returns the result so far."""
    reader = spark.readStream.schema(ROLE_SCHEMAS["worklog"])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    store = Snapshots(spark, target)
    query = (
        reader.parquet(landing)
        .writeStream.foreachBatch(lambda batch, number: settle(store, batch, number, window, delay, block) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return hourly_time_so_far(spark, target, block)
