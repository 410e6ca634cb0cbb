"""SparkSession construction and shared-storage settings."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  Partition counts are left to the cluster
# (AQE coalesces small shuffles and splits skewed join partitions).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "opsmetrics", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Tables written there must be reachable from every executor, so on a
    cluster the setting is required.  Only on a local master, as in tests,
    is a scratch folder created where it is unset.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()  # a folder of its own inside the one that was set
    if not d and current:
        d = current
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
        d = tempfile.mkdtemp(prefix="opsmetrics-ckpt-", dir=os.environ.get("OPSMETRICS_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not current:
        spark.sparkContext.setCheckpointDir(d)
    return d
