"""Distinct workers per hour as a stream: bitmaps that are united, never counted again.

A streaming aggregation has no exact distinct count.  Each micro-batch
numbers its new workers (``plans.distinct.worker_ids``) and writes the
bitmaps of the hours it touches as one part; both are committed together
with the batch's number (``sources.snapshots``), so a replayed batch changes nothing.
A union does not mind order or repetition: late rows are simply taken in.
Parts are united into one when there are ``COMPACT`` of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.windows import hour_bucket
from ..plans.distinct import distinct_users, user_bitmaps, worker_ids
from ..sources.snapshots import Snapshot, Snapshots
from .hourly_items import DETAIL_SCHEMA

KEYS = ["warehouse", "process", "timestamp"]
COMPACT = 24


def take(store: Snapshots, batch: DataFrame, number: int) -> Snapshot:
    """Take one micro-batch of item detail rows into the dictionary and the bitmaps."""
    head = store.head()
    if head.notes.get("batch", -1) >= number:
        return head
    rows = batch.where("emailaddress is not null").select("warehouse", "process", "emailaddress", hour_bucket("lastmodifieddate").alias("timestamp"))
    ids, schema = store.write(worker_ids(rows, store.read("ids", head)), "ids")
    named = store.folders(Snapshot(schemas={"ids": schema}), "ids", list(ids.values()))
    users = store.write(user_bitmaps(rows.distinct(), named, KEYS), "users", key=f"{number:012d}")
    made = store.commit(head, {"ids": (ids, schema), "users": users}, notes={"batch": number})
    if len(made.tables["users"]) >= COMPACT:
        united = store.read("users", made).groupBy(*KEYS, "part").agg(F.bitmap_or_agg("workers").alias("workers"))
        made = store.commit(made, {"users": store.write(united, "users", key=max(made.keys("users")))}, replace=("users",))
    store.vacuum()
    return made


def users_so_far(spark: SparkSession, target: str, *by: str) -> DataFrame:
    """Distinct workers by hour (or by any other grouping of the bitmaps) over all batches taken."""
    users = Snapshots(spark, target).read("users")
    if users is None:
        return spark.createDataFrame([], "warehouse string, process string, timestamp timestamp_ntz, Distinct_User long")
    return distinct_users(users, *(by or KEYS))


def run_available(spark: SparkSession, source: str, target: str, checkpoint: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Take all item files in ``source`` that the checkpoint has not seen (availableNow)."""
    reader = spark.readStream.schema(DETAIL_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    store = Snapshots(spark, target)
    query = (
        reader.parquet(source)
        .writeStream.foreachBatch(lambda batch, number: take(store, batch, number) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return users_so_far(spark, target)
