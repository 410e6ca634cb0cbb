import os

import pytest
from conftest import T, role_df

from opsmetrics import registry, session
from opsmetrics.sources import roles as R
from opsmetrics.sources import testdata as mapping

SF = "/root/testdata/sf0.001"


class _Cluster:
    """What checkpoint_dir asks a session for, with a cluster's master and nothing set."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_must_name_the_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(_Cluster)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_roles_are_staged_one_by_one(spark):
    folder = session.checkpoint_dir(spark)
    r = mapping.testdata_roles(spark, SF)
    before = set(os.listdir(folder))
    assert r.grc_v.count() > 0
    new = set(os.listdir(folder)) - before
    assert sum(os.path.isdir(os.path.join(folder, n, x)) for n in new for x in os.listdir(os.path.join(folder, n))) <= 1
    assert mapping.testdata_roles(spark, SF).grc_v.inputFiles() == r.grc_v.inputFiles()  # not staged again


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_the_loaded_hourly_table_follows_its_sources(spark, tmp_path):
    early_rows = {"events": "ts < TIMESTAMP_NTZ'2024-01-10 00:00:00'", "lineitem": "datediff(CAST(l_shipdate AS DATE), DATE'1995-01-01') % 30 < 9"}
    for name in mapping.TABLES:
        spark.read.parquet(f"{SF}/{name}.parquet").filter(early_rows.get(name, "true")).write.parquet(f"{tmp_path}/{name}.parquet")
    early = registry.q_high_watermark(spark, str(tmp_path)).collect()
    assert registry.q_high_watermark(spark, str(tmp_path)).collect() == early and early[0][0] is not None
    for name, early_part in early_rows.items():
        spark.read.parquet(f"{SF}/{name}.parquet").filter(f"NOT ({early_part})").write.mode("append").parquet(f"{tmp_path}/{name}.parquet")
    assert registry.q_high_watermark(spark, str(tmp_path)).collect()[0][0] > early[0][0]


def test_jdbc_options_and_role_types(spark):
    split = R.JdbcSplit("lastmodifieddate", "2024-01-01", "2024-02-01", 31)
    got = R.jdbc_options("jdbc:postgresql://db/x", "(SELECT 1) t", split)
    assert got["partitionColumn"] == "lastmodifieddate" and got["numPartitions"] == "31" and got["lowerBound"] == "2024-01-01"
    assert "partitionColumn" not in R.jdbc_options("u", "t")
    raw = spark.createDataFrame([("7", "b", 3, "5", "more")], "productid string, brandid string, productcatid int, subcatid string, other string")
    role = R.as_role(raw, "productdetails")
    assert role.dtypes == role_df(spark, "productdetails", []).dtypes
    assert [tuple(x) for x in role.collect()] == [(7, "b", "3", 5)]


def test_roles_are_read_anew(spark, tmp_path):
    path = str(tmp_path / "log")
    row = dict(warehouse="w", logid=1, emailaddress="a", modulename="m", status="in", actiontime=T("2024-01-08 10:00"))
    role_df(spark, "worklog", [row]).write.parquet(f"{path}/worklog")
    r = R.parquet_roles(spark, path)
    assert r.worklog.count() == 1
    role_df(spark, "worklog", [row]).write.mode("append").parquet(f"{path}/worklog")
    assert r.fresh().worklog.count() == 2
