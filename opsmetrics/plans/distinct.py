"""Distinct workers that add up: exact bitmaps over a worker dictionary.

A distinct count of a day does not follow from the counts of its hours, so
the daily roll-up reads worker-hours again.  Here each hour keeps a bitmap of
its workers; a day's bitmap is the union of its hours', and its count is exact.

``worker_ids`` numbers the workers densely and for good: new workers go on
from the numbers given before.  Numbers are dealt in ``LANES`` lanes by a hash, so
no task ever numbers all workers.  ``hourly_parts`` is the stored table:
quantity and time (which add up anyhow) and the bitmap of each hour and
range of 32,768 numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import exact_sum, micros_to_seconds, per_hour
from ..spec import HOUR_SECONDS

LANES = 64


def worker_ids(workers: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """emailaddress, id: the known numbers and new ones for the workers that have none (NULL is no worker)."""
    new = workers.select("emailaddress").where("emailaddress is not null").distinct()
    lane = F.pmod(F.xxhash64("emailaddress"), F.lit(LANES))
    if known is not None:
        new = new.join(known, "emailaddress", "left_anti")
    nth = F.row_number().over(Window.partitionBy("lane").orderBy("emailaddress")).cast("long")
    new = new.withColumn("lane", lane).withColumn("nth", nth)
    if known is None:
        return new.select("emailaddress", ((F.col("nth") - 1) * LANES + F.col("lane")).alias("id"))
    used = known.groupBy(F.pmod("id", F.lit(LANES)).alias("lane")).agg(F.max(F.floor(F.col("id") / LANES)).alias("top"))
    new = new.join(used, "lane", "left").select(
        "emailaddress", ((F.coalesce(F.col("top") + 1, F.lit(0)) + F.col("nth") - 1) * LANES + F.col("lane")).cast("long").alias("id"))
    return known.select("emailaddress", "id").unionByName(new)


def user_bitmaps(rows: DataFrame, ids: DataFrame, keys: list[str], *sums) -> DataFrame:
    """keys, part, workers (bitmap) and the given sums."""
    known = rows.join(ids, "emailaddress")
    return known.groupBy(*keys, F.bitmap_bucket_number("id").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("workers"), *sums)


def hourly_parts(raw: DataFrame, ids: DataFrame) -> DataFrame:
    """warehouse, process, timestamp, part, workers, QTY, working_us from worker-hour rows."""
    return user_bitmaps(raw, ids, ["warehouse", "process", "timestamp"], F.sum("QTY").alias("QTY"), exact_sum(F.col("working_us")).alias("working_us"))


def daily_from_parts(parts: DataFrame) -> DataFrame:
    """``hourly.daily_report`` from the stored hours alone."""
    days = parts.groupBy("warehouse", "process", F.to_date("timestamp").alias("date"), "part").agg(
        F.bitmap_or_agg("workers").alias("workers"), F.sum("QTY").alias("QTY"), exact_sum(F.col("working_us")).alias("working_us"))
    g = days.groupBy("warehouse", "process", "date").agg(
        F.sum("QTY").alias("QTY"), F.sum(F.bitmap_count("workers")).alias("Distinct_User"), exact_sum(F.col("working_us")).alias("_us"))
    rate = per_hour(F.col("QTY"), micros_to_seconds(F.col("_us")), None, (float(HOUR_SECONDS),))
    return g.select("warehouse", "process", "date", "QTY", "Distinct_User", rate.alias("EPH"))


def distinct_users(parts: DataFrame, *by: str) -> DataFrame:
    """Exact distinct workers of any coarser grouping ``by`` of stored bitmaps."""
    return (parts.groupBy(*by, "part").agg(F.bitmap_or_agg("workers").alias("workers"))
            .groupBy(*by).agg(F.sum(F.bitmap_count("workers")).alias("Distinct_User")))
