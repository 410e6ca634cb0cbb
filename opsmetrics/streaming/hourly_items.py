"""Hourly item totals as a Structured Streaming query.

The hourly job reloads complete hours; the streaming form reads item
detail rows as they land in a directory, assigns them to one-hour
tumbling windows and emits the totals of every hour that a micro-batch
changed, the hour still open included (update mode); the sink commits each
batch's changes as a version, unites them from time to time, and the newest
totals of an hour are the valid ones.
Rows arriving later than the watermark allows are dropped by Spark;
the watermark delay is that explicit bound.

Only sums are streamed: exact distinct counts are not supported on
streams, and the working-time side needs ``lag`` over each worker's log,
which streams do not support either; those stay in the batch job.
The category lookup is a NULL-safe stream-static left join to the
deduplicated product table, as in the batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.windows import instant_to_ntz, ntz_to_instant
from ..operators.products import dedup_products, with_category
from ..sources.snapshots import Snapshot, Snapshots
from ..spec import CATEGORY_CONSUMABLE

DETAIL_SCHEMA = T.StructType(
    [
        T.StructField("emailaddress", T.StringType()),
        T.StructField("businesstype", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("processquantity", T.DoubleType()),
        T.StructField("notfoundquantity", T.DoubleType()),
        T.StructField("productid", T.LongType()),
        T.StructField("lastmodifieddate", T.TimestampNTZType()),
        T.StructField("process", T.StringType()),
        T.StructField("warehouse", T.StringType()),
    ]
)


def hourly_item_totals(detail_stream: DataFrame, products: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Streaming aggregate: warehouse, process, hour -> Quantity, Consumable_Qty, QTY, totalnotfound.

    Watermarks need a TIMESTAMP (not NTZ) column: the zone-less stamp is
    mapped to the instant with the same UTC wall time (so one-hour windows
    fall on whole wall-clock hours in any session zone) and mapped back on
    output.
    """
    pq = F.col("processquantity")
    s = detail_stream.where(F.col("emailaddress").isNotNull()).withColumn("event_time", ntz_to_instant("lastmodifieddate"))
    s = with_category(s, dedup_products(products), null_safe=True).withWatermark("event_time", delay)
    g = s.groupBy(F.window("event_time", "1 hour").alias("w"), "warehouse", "process").agg(
        F.coalesce(F.sum(pq), F.lit(0.0)).alias("Quantity"),
        F.coalesce(F.sum("notfoundquantity"), F.lit(0.0)).alias("totalnotfound"),
        F.coalesce(F.sum(F.when(F.col("productcatid") == CATEGORY_CONSUMABLE, pq).otherwise(F.lit(0.0))), F.lit(0.0)).alias(
            "Consumable_Qty"
        ),
    )
    return g.select(
        "warehouse",
        "process",
        instant_to_ntz("w.start").alias("timestamp"),
        "Quantity",
        "totalnotfound",
        "Consumable_Qty",
        (F.col("Quantity") - F.col("Consumable_Qty")).alias("QTY"),
    )


TOTALS = ("warehouse string, process string, timestamp timestamp_ntz, Quantity double, totalnotfound double, "
          "Consumable_Qty double, QTY double")
KEYS = ("warehouse", "process", "timestamp")
# So many batches' folders are united into one that holds each hour once.
COMPACT = 24


def newest(rows: DataFrame) -> DataFrame:
    """Of each hour's rows those of the last batch that changed it."""
    values = [c for c in rows.columns if c not in KEYS]
    return rows.groupBy(*KEYS).agg(F.max_by(F.struct(*values), "batch").alias("v")).select(*KEYS, "v.*")


def take(store: Snapshots, batch: DataFrame, number: int, compact: int = COMPACT) -> Snapshot:
    """Commit one micro-batch's changed hours with its number; a batch that was committed before changes nothing."""
    head = store.head()
    if head.notes.get("batch", -1) >= number:
        return head
    rows = batch.withColumn("batch", F.lit(number).cast("long"))
    made = store.commit(head, {"totals": store.write(rows, "totals", key=f"{number:012d}")}, notes={"batch": number})
    if len(made.tables["totals"]) >= compact:
        united = store.write(newest(store.read("totals", made)), "totals", key=max(made.keys("totals")))
        made = store.commit(made, {"totals": united}, replace=("totals",))
    store.vacuum()
    return made


def current_totals(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The newest totals of every hour over all batches taken."""
    rows = Snapshots(spark, sink_dir).read("totals")
    if rows is None:
        return spark.createDataFrame([], TOTALS)
    return newest(rows).drop("batch")


def run_available(
    spark: SparkSession,
    source_dir: str,
    products: DataFrame,
    sink_dir: str,
    checkpoint: str,
    delay: str = "1 hour",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Process everything currently in ``source_dir`` (trigger availableNow) into a versioned sink.

    Update mode: every micro-batch commits the hours it changed, the open
    one included, together with its number, so a batch that is repeated
    after a failure counts once; ``COMPACT`` batches become one folder.
    The query's checkpoint makes reruns continue where the last run
    stopped (sink and checkpoint belong together); the newest totals are
    returned.
    """
    store = Snapshots(spark, sink_dir)
    reader = spark.readStream.schema(DETAIL_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (
        hourly_item_totals(reader.parquet(source_dir), products, delay)
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, number: take(store, batch, number) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return current_totals(spark, sink_dir)
