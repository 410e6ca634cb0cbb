"""Shared helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# Word characters as the contracts state them: everything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# Bytes of one Arrow batch handed to a Python worker, so that long texts cannot pile up in its memory.
BATCH_BYTES = "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SENT: set[str] = set()  # applications whose executors have this package


def send_package(spark: SparkSession) -> None:
    """Send this package's source files to the executors, once for each application.

    Functions and models are pickled by reference, so the Python workers
    must find the package, wherever they are started.
    """
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="opsmetrics-src-")) / "opsmetrics.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))  # Spark's file server hands it to each executor
    _SENT.add(app)


def bounded_batches(spark: SparkSession) -> None:
    """What every operator with Python tasks needs first: the package at the workers, and Arrow batches bounded by bytes."""
    send_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def evaluated_once(udf):
    """``udf`` for a column that both a filter and what follows it read.

    Spark pushes a filter on a deterministic UDF's column below it, and so
    works the UDF out twice for each row, with two Python workers in every
    task, all of which an executor then keeps.  This holds the filter above.
    """
    return udf.asNondeterministic()


def store(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage: a lost executor costs no recomputation of what
    stands before, and a frame that several steps read is computed once.
    The folder is the one that ``spark.checkpoint.dir`` names.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(schema).parquet(path)


def bounded_sample(rows: DataFrame, by: str, key: list[str], limits: dict) -> DataFrame:
    """At most ``limits[value]`` rows of each value of ``by``, the first in the order of a hash of ``key``; column ``nth`` counts them.

    The hash order is cut at twice the share that is wanted before any
    row is shuffled, so a frequent value sends about twice its limit to
    the task that ranks it, however many rows it has.
    """
    totals = {r[by]: r["count"] for r in rows.groupBy(by).count().collect()}
    order = F.xxhash64(*key)
    first = F.lit(False)
    for value, total in totals.items():
        share = min(1.0, 2 * limits[value] / total)
        first = F.when(F.col(by) == value, order <= F.lit(min((1 << 63) - 1, int(-(1 << 63) + share * (1 << 64))))).otherwise(first)
    nth = F.row_number().over(W.partitionBy(by).orderBy(order, *key))
    some = rows.filter(first).withColumn("nth", nth)
    limit = F.lit(0)
    for value in totals:
        limit = F.when(F.col(by) == value, limits[value]).otherwise(limit)
    return some.filter(F.col("nth") <= limit)


def crc_mod(doc_id, mod: int):
    """crc32 of the id as text, modulo ``mod`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod
