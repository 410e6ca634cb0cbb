"""Items and tasks in matching buckets, so their semi join moves no item.

Both tables are stored through Spark's catalog, bucketed and sorted by
(tier, warehouse, taskid, salt) with the same number of buckets.  The semi
join of a report then reads bucket against bucket, with no exchange on
either side, however often reports run.  The tier is a bucket key and not
a folder, as every equality key of the join must be one; it leads the
sort, so the files' statistics still tell the tiers apart.  The salt spreads the items of a task
that holds many over ``SALTS`` buckets by their id, and such a task is
stored once for each salt, so a task that holds a third of the items is
not one bucket's work; all other tasks, nearly all, are stored once.

``buckets`` is fixed when the tables are stored: ``buckets_for`` gives a
number with which no bucket holds more than about ``BUCKET_ROWS`` rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.windows import DAY

SALT, SALTS = "salt", 8
TASK = ("tier", "warehouse", "taskid")
KEYS = (*TASK, SALT)
BUCKET_ROWS = 1_000_000  # of one bucket, which one task sorts
# Tasks are counted by hash slots, so many for each bucket: a slot's tasks are spread over the salts
# when they hold more than this share of a bucket's items together.
SLOTS, HOT_SHARE = 1000, 0.1
_SLOT = "_slot"


@dataclass(frozen=True)
class BucketedTables:
    """Names of the two stored tables in the session's catalog."""

    items: str
    tasks: str

    def read(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        return spark.table(self.items), spark.table(self.tasks)

    def drop(self, spark: SparkSession) -> None:
        """Take the names out of the catalog; the files stay where they were stored."""
        for name in (self.items, self.tasks):
            spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def _store(df: DataFrame, name: str, path: str, by: tuple[str, ...], buckets: int) -> None:
    # Dealt as the buckets are, so each bucket is one file in each folder and one task's work.
    out = df.repartition(buckets, *KEYS).sortWithinPartitions(*by, *KEYS)
    out.write.partitionBy(*by).bucketBy(buckets, *KEYS).sortBy(*KEYS).option("path", path).mode("overwrite").saveAsTable(name)


def buckets_for(items: DataFrame, tasks: DataFrame, least: int = 1) -> int:
    """Buckets for tables of this size, ``least`` at least."""
    return max(least, -(-max(items.count(), tasks.count()) // BUCKET_ROWS))


def store_bucketed(items: DataFrame, tasks: DataFrame, base: str, name: str, buckets: int, salts: int = SALTS) -> BucketedTables:
    """Store the item and task roles in matching buckets under ``base`` and name them ``{name}_items`` and ``{name}_tasks``."""
    base = base.rstrip("/")
    tables = BucketedTables(f"{name}_items", f"{name}_tasks")
    # Items with a NULL in the task's key meet no task and are spread too.
    lone = F.lit(False)
    for k in TASK:
        lone = lone | F.col(k).isNull()
    slot = F.pmod(F.xxhash64(*TASK), F.lit(SLOTS * buckets)).alias(_SLOT)
    held = items.where(~lone).groupBy(slot).agg(F.count(F.lit(1)).alias("_n"))
    hot = held.where(F.col("_n") > HOT_SHARE * items.count() / buckets).select(_SLOT, F.lit(True).alias("_hot"))
    hot.write.mode("overwrite").parquet(f"{base}/hot")  # so that Spark knows its size: few slots, joined without a shuffle
    hot = items.sparkSession.read.schema(hot.schema).parquet(f"{base}/hot")
    salt = F.when(F.col("_hot") | lone, F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    salted = items.drop(DAY).withColumn(_SLOT, slot).join(hot, _SLOT, "left").withColumn(SALT, salt).drop(_SLOT, "_hot")
    _store(salted, tables.items, f"{base}/items", ("item_table",), buckets)
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copies = tasks.withColumn(_SLOT, slot).join(hot, _SLOT, "left").withColumn(SALT, F.explode(every)).drop(_SLOT, "_hot")
    _store(copies, tables.tasks, f"{base}/tasks", ("tasktype",), buckets)
    return tables


def bucketed_semi_join(items: DataFrame, tasks: DataFrame) -> DataFrame:
    """``operators.items.for_tasks`` over the stored tables: items with a task of the same tier among ``tasks``.

    The hint asks for a merge of the buckets, with which no side is ever
    collected for a broadcast.
    """
    return items.join(tasks.select(*KEYS).hint("merge"), list(KEYS), "left_semi").drop(SALT)
