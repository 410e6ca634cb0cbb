"""Worker-hour item totals joined to working time, both as streams.

    items --(watermark)--> totals of each hour and worker --+
                                                            +-- left outer join on hour, warehouse, process, worker
    time  --(watermark)--> one row of each hour and worker -+

Two aggregations and the outer join stand in one query (chained stateful
operators, append mode).  An hour is given out once, when both inputs'
watermarks have passed its end: with its working time if that has come, else
without, and never again.  The watermark is the lower one of both inputs, so
a side that lags behind holds the other side's rows back, in state, and
loses none; a side that stays silent keeps the last hours open until a
later row of it comes (``end_mark`` gives such a row).

What state holds follows the workers and the hours between the watermark
and the newest row, not the length of the stream.  Rows that come later
than ``delay`` are dropped by Spark; ``plans.late_hours`` finds their hours.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.windows import instant_to_ntz, ntz_to_instant, ts_lit
from ..operators.products import dedup_products, with_category
from ..plans.hourly import RAW_KEYS, item_sums
from .hourly_items import DETAIL_SCHEMA

TIME_SCHEMA = "warehouse string, process string, timestamp timestamp_ntz, emailaddress string, working_us decimal(38,0)"
TOTALS = ("warehouse string, process string, timestamp timestamp_ntz, emailaddress string, Quantity double, totalnotfound double, "
          "B2B_Qty double, B2C_Qty double, BabyGear_Qty double, Consumable_Qty double, working_us decimal(38,0)")
_KEYS = ("warehouse", "process", "emailaddress")


def pick_time(detail: DataFrame, time: DataFrame, products: DataFrame, delay: str = "1 hour") -> DataFrame:
    """``hourly.with_time`` of two streams; ``time`` has ``sessions.hourly_working_time``'s keys and ``working_us``.

    A worker-hour that the time stream holds twice (a repeated delivery)
    counts once, with the larger time.  Rows of a NULL worker are dropped
    on both sides.
    """
    worker = F.col("emailaddress").isNotNull()
    hour = F.window("event_time", "1 hour")
    d = with_category(detail.where(worker).withColumn("event_time", ntz_to_instant("lastmodifieddate")), dedup_products(products), null_safe=True)
    totals = d.withWatermark("event_time", delay).groupBy(hour.alias("w"), *_KEYS).agg(*item_sums())
    t = time.where(worker).withColumn("event_time", ntz_to_instant("timestamp")).withWatermark("event_time", delay)
    t = t.groupBy(hour.alias("_w"), *[F.col(k).alias(f"_{k}") for k in _KEYS]).agg(F.max("working_us").alias("working_us"))
    same = F.col("w") == F.col("_w")
    for k in _KEYS:
        same = same & (F.col(k) == F.col(f"_{k}"))
    values = [c for c in totals.columns if c not in ("w", *_KEYS)]
    j = totals.join(t, same, "left_outer").withColumn("timestamp", instant_to_ntz("w.start"))
    return j.select(*RAW_KEYS, *values, "working_us")


def end_mark(spark: SparkSession, at: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """A row of each input that only moves the watermark: its own hour stays open as long as nothing later comes."""
    one = spark.range(1)
    none = F.lit("")  # not NULL: rows with a NULL key of the join are left out before the watermark sees them
    mark = {**{k: none for k in _KEYS}, "lastmodifieddate": ts_lit(at), "timestamp": ts_lit(at)}
    row = lambda fields: one.select(*[mark.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
    return row(DETAIL_SCHEMA.fields), row(spark.createDataFrame([], TIME_SCHEMA).schema.fields)


def run_available(
    spark: SparkSession, detail_dir: str, time_dir: str, products: DataFrame, sink_dir: str, checkpoint: str, delay: str = "1 hour"
) -> DataFrame:
    """Process everything that has landed in both folders; the hours closed so far are returned.

    The file sink's log lists the files of finished batches, so a batch
    that is repeated after a failure counts once.
    """
    detail = spark.readStream.schema(DETAIL_SCHEMA).parquet(detail_dir)
    time = spark.readStream.schema(TIME_SCHEMA).parquet(time_dir)
    q = (
        pick_time(detail, time, products, delay)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", sink_dir)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.schema(TOTALS).parquet(sink_dir)
