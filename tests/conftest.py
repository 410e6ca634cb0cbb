import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from opsmetrics.session import BASE_CONF  # noqa: E402
from opsmetrics.sources.roles import ROLE_SCHEMAS, Roles  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    b = SparkSession.builder.master("local[*]").appName("opsmetrics-tests").config("spark.sql.shuffle.partitions", "8")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    scratch = tempfile.mkdtemp(prefix="opsmetrics-test-")
    b = b.config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def T(s: str) -> dt.datetime:
    """'2024-01-08 09:10' or '... 09:10:05' -> datetime."""
    fmt = "%Y-%m-%d %H:%M:%S" if s.count(":") == 2 else "%Y-%m-%d %H:%M"
    return dt.datetime.strptime(s, fmt)


def role_df(spark, role: str, rows: list[dict]):
    """DataFrame of a role schema from dict rows (missing columns are NULL)."""
    schema = ROLE_SCHEMAS[role]
    names = [f.strip().split(" ")[0] for f in schema.split(",")]
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, schema)


def make_roles(spark, **tables) -> Roles:
    loaders = {}
    for role, rows in tables.items():
        df = role_df(spark, role, rows)
        loaders[role] = (lambda d=df: d)
    for role in ROLE_SCHEMAS:
        if role not in loaders:
            empty = role_df(spark, role, [])
            loaders[role] = (lambda d=empty: d)
    return Roles(spark, loaders)
