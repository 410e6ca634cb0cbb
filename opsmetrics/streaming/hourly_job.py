"""The hourly job driven by a stream of newly landed work-log rows.

Working time needs ``lag(status)`` over each worker's log in order, which
a streaming aggregation cannot do, and an hour's value can change when
rows of that hour arrive late.  So the stream carries no state of its
own: each micro-batch only tells which days received rows, and
``foreachBatch`` recomputes those whole days from the stored role tables
with the batch job (``incremental.run_window`` in upsert mode), replacing
their raw, daily and hourly partitions.  Replaying a batch after a failure
rewrites the same partitions; the query checkpoint records which files
were handled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.windows import ReportWindow
from ..plans.incremental import run_window
from ..sources.roles import ROLE_SCHEMAS


def touched_days(batch: DataFrame, col: str = "actiontime") -> list[ReportWindow]:
    """The days that received rows, neighbouring days as one window (one date per day to the driver)."""
    rows = batch.select(F.to_date(col).alias("day")).where("day is not null").distinct().collect()
    runs: list[list[dt.date]] = []
    for day in sorted(r["day"] for r in rows):
        if runs and day - runs[-1][1] == dt.timedelta(days=1):
            runs[-1][1] = day
        else:
            runs.append([day, day])
    return [ReportWindow(dt.datetime.combine(a, dt.time()), dt.datetime.combine(b, dt.time(23, 59, 59))) for a, b in runs]


def start_hourly_job(
    spark: SparkSession,
    roles,
    landing: str,
    target: str,
    checkpoint: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
):
    """Watch ``landing`` (work-log rows in the role schema) and keep ``target`` up to date."""

    def load(batch: DataFrame, epoch_id: int) -> None:
        for w in touched_days(batch):
            # Resolved for each batch: a frame kept from before would read the files of that time.
            run_window(spark, roles.fresh(), target, w, mode="upsert")

    reader = spark.readStream.schema(ROLE_SCHEMAS["worklog"])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = reader.parquet(landing).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()
