"""Stored roles and buckets: a task's rows stay bounded however the rows are spread."""

import datetime as dt
import os
import time
import uuid

from pyspark.sql import functions as F

from conftest import T, role_df
from opsmetrics.sources import bucketed
from opsmetrics.sources import roles as R
from opsmetrics.sources import testdata as mapping


def test_parts_follow_the_rows():
    assert [R.parts_for(n) for n in (0, 1, 200_000, 200_001, 36_000_000, 216_000_000)] == [1, 1, 1, 2, 180, 216]
    assert all(n / R.parts_for(n) <= R.MOST_PART_ROWS for n in (10**6, 10**7, 10**8, 10**9, 10**10))


def _rows_of_tasks(path) -> list[int]:
    """Rows of each writing task, which names its files by its number."""
    import pyarrow.parquet as pq

    found: dict[str, int] = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.startswith("part-"):
                found[n[5:10]] = found.get(n[5:10], 0) + pq.read_metadata(os.path.join(folder, n)).num_rows
    return list(found.values())


def test_one_folder_and_one_stamp_are_many_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "PART_ROWS", 100, raising=False)
    rows = [dict(tier="live", warehouse=None if i % 50 == 0 else "w", taskid=i, tasktype="Packing", startdate=None if i % 90 == 0 else T("2024-01-08 00:00")) for i in range(1000)]
    R.store_role(role_df(spark, "tasks", rows), str(tmp_path / "tasks"), "tasks")
    sizes = _rows_of_tasks(tmp_path)
    assert sum(sizes) == 1000 and len(sizes) >= 5 and max(sizes) <= 300, sizes
    got = R.parquet_roles(spark, str(tmp_path)).tasks
    assert sorted(map(repr, got.collect())) == sorted(map(repr, role_df(spark, "tasks", rows).select(*got.columns).collect()))


def test_only_tasks_with_many_items_are_copied(spark, tmp_path):
    items = [dict(item_table="pick", tier="live", warehouse="w", id=i, taskid=7 if i < 200 else i, lastmodifieddate=T("2024-01-08 09:00") + dt.timedelta(seconds=i)) for i in range(400)]
    items += [dict(item_table="pick", tier="live", warehouse=None, id=1000 + i, taskid=None) for i in range(100)]
    tasks = [dict(tier="live", warehouse="w", taskid=i, tasktype="Picking") for i in (7, *range(200, 400, 2))] + [dict(tier="live", tasktype="Picking")]
    tables = bucketed.store_bucketed(role_df(spark, "items", items).withColumn("stamp_day", F.lit(None).cast("date")), role_df(spark, "tasks", tasks), str(tmp_path), f"b_{uuid.uuid4().hex}", 8)
    stored_items, stored_tasks = tables.read(spark)
    assert stored_items.count() == 500 and stored_tasks.count() == 102 + bucketed.SALTS - 1
    assert stored_items.where("taskid is null").select(bucketed.SALT).distinct().count() > 1
    found = bucketed.bucketed_semi_join(stored_items, stored_tasks)
    assert sorted(r["id"] for r in found.collect()) == sorted([*range(200), *range(200, 400, 2)])
    tables.drop(spark)


def test_buckets_follow_the_rows(spark, monkeypatch):
    items, tasks = spark.range(95), spark.range(10)
    assert bucketed.buckets_for(items, tasks) == 1 and bucketed.buckets_for(items, tasks, 16) == 16
    monkeypatch.setattr(bucketed, "BUCKET_ROWS", 10)
    assert bucketed.buckets_for(items, tasks, 2) == bucketed.buckets_for(tasks, items) == 10


def _shuffles(spark) -> set[str]:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().toIndexedSeq()
    return {n for n in (blocks.apply(k).getName() for k in range(blocks.size())) if n.startswith("shuffle_")}


def test_staging_keeps_no_shuffle_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "PART_ROWS", 100)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    spark.sparkContext._jvm.System.gc()
    before = _shuffles(spark)
    df = role_df(spark, "grc_g", [dict(grcno=i, lastmodifieddate=T("2024-01-10 10:00") + dt.timedelta(hours=i)) for i in range(500)])
    R.store_role(df, str(tmp_path / "grc_g"), "grc_g")
    until = time.time() + 20
    while time.time() < until and _shuffles(spark) - before:
        time.sleep(0.2)
    left = {n for n in _shuffles(spark) - before if n.endswith(".data")}
    assert not left and spark.conf.get(key) == was, left
    assert R.parquet_roles(spark, str(tmp_path)).grc_g.count() == 500


def test_a_source_is_dealt_and_the_role_made_as_it_is_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "PART_ROWS", 100)
    rows = [(None if i % 50 == 0 else i, None if i % 7 == 0 else T("2024-01-10 00:00") + dt.timedelta(hours=i % 60), i % 3) for i in range(600)]
    source = spark.createDataFrame(rows + rows[:20], "l_orderkey bigint, at timestamp_ntz, kind int")
    made = {c: F.lit(None).cast(t) for c, t in (f.strip().split(" ") for f in R.ROLE_SCHEMAS["grc_g"].split(","))}
    made |= {"grcno": F.col("l_orderkey"), "lastmodifieddate": F.expr("timestampadd(SECOND, 59, at)"), "grcstatus": F.expr("CASE kind WHEN 1 THEN 'grconhold' END")}
    plan = R.laid_out(source, "grc_g", made)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RepartitionByExpression")
    assert "AS grcstatus" in above and "AS grcstatus" not in below, plan
    R.store_role(source, str(tmp_path / "grc_g"), "grc_g", made=made)
    sizes = _rows_of_tasks(tmp_path)
    assert sum(sizes) == 620 and len(sizes) >= 4 and max(sizes) <= 300, sizes
    stored = R.parquet_roles(spark, str(tmp_path)).grc_g
    want = source.select(*[c.alias(n) for n, c in made.items()]).withColumn("stamp_day", F.to_date("lastmodifieddate"))
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, want.select(*stored.columns).collect()))


def test_every_role_of_the_test_tables_is_made_of_its_source(spark, tmp_path):
    at = T("1995-02-03 00:00")
    spark.createDataFrame([(1, 2, 3, 1, 5.0, 7.5, 0.01, 0.02, "R", "F", at), (None,) * 11, (8, 50, 4, 2, 1.0, 2.5, 0.1, 0.07, "N", "O", at)],
                          "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                          "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "a"), (9, "b"), (None, "c")], "c_custkey bigint, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    assert mapping.made_of("grc_pd") is None and mapping.made_of("tasks") is None
    stored = mapping.testdata_roles(spark, str(tmp_path))
    for role in ("grc_g", "items", "grc_i"):
        got, want = getattr(stored, role), mapping.role_frame(spark, str(tmp_path), role)
        assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect())), role
        assert all(f.endswith(".zstd.parquet") for f in got.inputFiles()), role
