import random

import pytest
from conftest import T, make_roles, role_df
from pyspark.sql import functions as F

from opsmetrics.functions.windows import ReportWindow
from opsmetrics.operators.items import active
from opsmetrics.operators.totals import packing_totals
from opsmetrics.plans.reports import report, report_lines
from opsmetrics.spec import PICKING

DAY = "2024-01-08 "
W = ReportWindow.of(DAY + "00:00:00", DAY + "11:59:59")


def item(**kw):
    base = dict(item_table="pick", tier="archive", warehouse="whracks10", id=1, emailaddress="a", businesstype="B2C",
                quantity=5.0, processquantity=5.0, notfoundquantity=0.0, productid=100, taskid=7, poid=70, whpoid=700,
                binid=1, whordertype="Multiple", lastmodifieddate=T(DAY + "10:00"))
    base.update(kw)
    return base


def task(**kw):
    base = dict(tier="archive", warehouse="whracks10", taskid=7, tasktype="Picking", taskname="Other", startdate=T(DAY + "09:00"), enddate=T(DAY + "12:00"))
    base.update(kw)
    return base


LOG = [dict(warehouse="whracks10", logid=1, emailaddress="a", modulename="wave_picking", status="in", actiontime=T(DAY + "09:00")),
       dict(warehouse="whracks10", logid=2, emailaddress="a", modulename="wave_picking", status="out", actiontime=T(DAY + "11:00"))]


def test_activity_null_semantics(spark):
    df = role_df(spark, "items", [item(id=1, processquantity=None, notfoundquantity=1.0),
                                  item(id=2, processquantity=None, notfoundquantity=0.0)])
    assert [r.id for r in active(df).collect()] == [1]


def test_product_fanout(spark):
    roles = make_roles(spark, items=[item()], tasks=[task()], worklog=LOG,
                       productdetails=[dict(productid=100, brandid="b", productcatid="7", subcatid=1),
                                       dict(productid=100, brandid="b", productcatid="999", subcatid=2),
                                       dict(productid=100, brandid="c", productcatid="999", subcatid=3)])
    assert report_lines(roles, PICKING, W).count() == 2  # equal categories collapse under DISTINCT
    r = report(roles, "report_picking", W, hours_as="seconds").collect()[0]
    assert (r.total_picking_qty, r.babygear_qty, r.consumable_qty) == (10.0, 5.0, 5.0)
    assert r.total_working_hrs == 7200.0
    assert r.picking_eph == 5.0  # 10 / 7200 s * 3600


def test_tiers_double(spark):
    roles = make_roles(spark, items=[item(tier="live"), item(tier="archive")],
                       tasks=[task(tier="live"), task(tier="archive")], worklog=LOG)
    r = report(roles, "report_picking", W).collect()[0]
    assert r.total_picking_qty == 10.0
    assert r.total_working_hrs.total_seconds() == 7200


def test_null_worker_and_product(spark):
    roles = make_roles(spark, items=[item(id=1, emailaddress=None, productid=None), item(id=2)], tasks=[task()], worklog=LOG,
                       productdetails=[dict(productid=None, brandid="x", productcatid="7", subcatid=1)])
    rows = report(roles, "report_picking", W).collect()
    assert [r.emailaddress for r in rows] == ["a", None]  # NULL worker is its own group, sorted last
    assert rows[1].babygear_qty == 0.0  # NULL productid does not join in the SQL form
    assert rows[1].total_working_hrs is None


def test_qc_v2_negative_multiple(spark):
    its = [item(item_table="qc", id=i, whpoid=9, whordertype="Single") for i in (1, 2, 3)]
    log = [dict(l, modulename="qc_shipping") for l in LOG]
    roles = make_roles(spark, items=its, tasks=[task(tasktype="QCShipping")], worklog=log)
    r = report(roles, "report_qc_v2", W).collect()[0]
    assert (r.total_orders, r.single_whpo, r.multiple_whpo) == (1, 3, -2)
    assert r.eph_orders == 0.5


def test_conso_racking_task_names(spark):
    its = [item(id=1, taskid=1), item(id=2, taskid=2)]
    tks = [task(taskid=1, tasktype="Conso", taskname="B2BConsoRackIn"), task(taskid=2, tasktype="Conso", taskname="Other")]
    roles = make_roles(spark, items=its, tasks=tks, worklog=LOG)
    r = report(roles, "report_conso_racking", W).collect()[0]
    assert r.total_picking_qty == 5.0


def _naive_packing(lines, om):
    j = lines.join(om, "poid", "left")
    pq = F.col("processquantity")
    z = lambda c, v: F.sum(F.when(c, v).otherwise(F.lit(0)).cast("double"))
    return j.groupBy("warehouse", "emailaddress").agg(
        F.sum(pq).alias("totalprocess"),
        z(F.col("productcatid") == "7", pq).alias("babygear_qty"),
        z(F.col("productcatid") == "999", pq).alias("consumable_qty"),
        z(F.col("ordertype") == "tagged", pq).alias("total_tagged_qty"),
        z(F.col("ordertype") == "nontagged", pq).alias("total_non_tagged_qty"),
        F.countDistinct("binid").alias("bin_count"),
    )


def test_packing_totals_equal_join(spark):
    rnd = random.Random(3)
    lines = [(rnd.choice(["a", "b", "c"]), "wh", rnd.randint(0, 6), rnd.choice([None, 1.0, 2.0, 0.0]),
              rnd.choice([None, "7", "999", "5"]), rnd.randint(0, 3)) for _ in range(300)]
    ldf = spark.createDataFrame(lines, "emailaddress string, warehouse string, poid bigint, processquantity double, "
                                       "productcatid string, binid bigint")
    om = [(rnd.randint(0, 8), rnd.choice(["tagged", "nontagged", None])) for _ in range(15)]
    odf = spark.createDataFrame(om, "poid bigint, ordertype string")
    got = {(r.warehouse, r.emailaddress): tuple(r)[2:] for r in packing_totals(ldf, odf).collect()}
    exp = {(r.warehouse, r.emailaddress): tuple(r)[2:] for r in _naive_packing(ldf, odf).collect()}
    assert got.keys() == exp.keys()
    for k in got:
        g = dict(zip(["totalprocess", "babygear_qty", "consumable_qty", "total_tagged_qty", "total_non_tagged_qty",
                      "bin_count"], got[k]))
        e = dict(zip(["totalprocess", "babygear_qty", "consumable_qty", "total_tagged_qty", "total_non_tagged_qty",
                      "bin_count"], exp[k]))
        assert g == e, k


@pytest.mark.parametrize("key", ["report_picking", "report_conso_racking", "report_packing"])
def test_sql_form_equals_dataframe_form(spark, key):
    from opsmetrics.plans.sql_reports import sql_report

    its = [item(id=1), item(id=2, emailaddress="b", productid=None), item(id=3, item_table="packing", taskid=8),
           item(id=4, taskid=9)]
    tks = [task(), task(taskid=8, tasktype="Packing"), task(taskid=9, tasktype="Conso", taskname="B2CExcessRackIn")]
    log = LOG + [dict(warehouse="whracks10", logid=3, emailaddress="b", modulename="bin/box_packing", status="out",
                      actiontime=T(DAY + "10:00"))]
    roles = make_roles(spark, items=its, tasks=tks, worklog=log,
                       productdetails=[dict(productid=100, brandid="b", productcatid="7", subcatid=1)])
    for block in (1, 1 << 20):
        a = sorted(map(tuple, sql_report(spark, roles, key, W, block=block).collect()), key=repr)
        b = sorted(map(tuple, report(roles, key, W, hours_as="hours").collect()), key=repr)
        assert a == b


def test_results_do_not_depend_on_session_time_zone(spark):
    from opsmetrics.plans.hourly import hourly_pipeline, hourly_report
    from opsmetrics.plans.sql_reports import sql_report

    its = [item(id=1, lastmodifieddate=T(DAY + "10:35")), item(id=2, emailaddress="b", lastmodifieddate=T(DAY + "11:50"))]
    roles = make_roles(spark, items=its, tasks=[task()], worklog=LOG)

    def run():
        a = sorted(map(tuple, report(roles, "report_picking", W, hours_as="hours").collect()), key=repr)
        b = sorted(map(tuple, sql_report(spark, roles, "report_picking", W).collect()), key=repr)
        c = sorted(map(tuple, hourly_report(hourly_pipeline(roles, W)).collect()), key=repr)
        return a, b, c

    base = run()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("Asia/Kolkata", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert run() == base, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_variants_count_items_and_single_orders_once(spark):
    its = [item(id=1, item_table="qc", whordertype="Single", whpoid=5), item(id=1, item_table="qc", tier="live", whordertype="Single", whpoid=5),
           item(id=2, item_table="qc", whordertype="Single", whpoid=5)]
    tks = [task(tasktype="QCShipping"), task(tier="live", tasktype="QCShipping")]
    roles = make_roles(spark, items=its, tasks=tks, worklog=LOG)
    plain = report(roles, "report_qc_v2", W).first()
    assert (plain.single_whpo, plain.multiple_whpo) == (3, -2)
    fixed = report(roles, "report_qc_v2", W, dedup=True, distinct_single=True).first()
    assert (fixed.single_whpo, fixed.multiple_whpo, fixed.total_qty) == (1, 0, 2 * its[0]["processquantity"])
    from opsmetrics.plans.hourly import pick_detail

    assert pick_detail(roles.items, roles.tasks, W).count() == 4
    assert sorted(r.process for r in pick_detail(roles.items, roles.tasks, W, dedup=True).collect()) == ["QC", "QC"]
