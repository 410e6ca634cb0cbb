"""Sinks: CSV report files, appended result tables, idempotent partition upserts.

All sinks write through Spark's writers into shared storage, so a lost
executor only re-runs its task; nothing passes through the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def printable(df: DataFrame) -> DataFrame:
    """CSV has no interval type: intervals are written as their SQL text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DayTimeIntervalType, T.YearMonthIntervalType)):
            cols.append(F.col(f.name).cast("string").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def report_dir(base: str, report: str, start: dt.datetime, run: dt.datetime | None = None) -> str:
    """``{base}/{report}/start=YYYY-MM-DD/run=YYYYmmddHHMMSS`` (one directory per run)."""
    run = run or dt.datetime.now()
    return f"{base.rstrip('/')}/{report}/start={start:%Y-%m-%d}/run={run:%Y%m%d%H%M%S}"


def write_csv(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = ("warehouse",),
    order: tuple[str, ...] = ("emailaddress",),
    mode: str = "overwrite",
) -> None:
    """Header CSV, one sub-directory ``for_warehouse=...`` each (the source wrote one file per warehouse).

    The warehouse is also a column of the files, and the rows of a file
    are in the report's worker order.
    """
    cols = [c for c in partition_by if c in df.columns]
    out = printable(df).withColumns({f"for_{c}": F.col(c) for c in cols})
    parts = tuple(f"for_{c}" for c in cols)
    keys = [F.col(c).asc_nulls_last() for c in (*parts, *(c for c in order if c in df.columns))]
    out = rebalanced(out, parts)
    w = (out.sortWithinPartitions(*keys) if keys else out).write.mode(mode).option("header", True)
    if parts:
        w = w.partitionBy(*parts)
    w.csv(path)


def write_report(df: DataFrame, base: str, report: str, start: dt.datetime, run: dt.datetime | None = None) -> str:
    """Write a report's CSV under its stamped name (``report_dir``); returns the folder."""
    path = report_dir(base, report, start, run)
    write_csv(df, path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def rebalanced(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Group rows by the output partition before a partitioned write.

    The ``rebalance`` hint lets AQE put each partition value in as few
    tasks as possible (few files per directory) while still splitting a
    partition value that is too large for one task.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def append(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Append rows to a Parquet table, created on first use."""
    w = rebalanced(df, partition_by).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Replace exactly the partitions present in ``df`` (dynamic partition overwrite).

    Re-running the same input rewrites the same partitions, so a retried
    or repeated run leaves one copy.
    """
    (
        rebalanced(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def clear_partitions(spark: SparkSession, path: str, schema: T.StructType, partition: str, values) -> None:
    """Empty the given values' partition folders of a table partitioned by one column."""
    inner = T.StructType([f for f in schema.fields if f.name != partition])
    for v in values:
        spark.createDataFrame([], inner).write.mode("overwrite").parquet(f"{path}/{partition}={v}")


def table_exists(spark: SparkSession, path: str) -> bool:
    """False for a path that is not there or holds no data files; any other failure rises."""
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def high_watermark(results: DataFrame, col: str = "timestamp") -> DataFrame:
    """One row, ``max_timestamp``: the last loaded hour bucket (NULL when empty)."""
    return results.agg(F.max(col).alias("max_timestamp"))
