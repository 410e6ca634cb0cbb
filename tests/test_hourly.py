from conftest import T, make_roles
from pyspark.sql import functions as F

from opsmetrics.functions.windows import ReportWindow
from opsmetrics.plans.hourly import daily_report, hourly_pipeline, hourly_report, pick_detail

DAY = "2024-01-08 "
W = ReportWindow.of(DAY + "09:00:00", DAY + "11:59:59")


def item(**kw):
    base = dict(item_table="pick", tier="archive", warehouse="whracks10", id=1, emailaddress="a", businesstype="B2B",
                quantity=5.0, processquantity=5.0, notfoundquantity=0.0, productid=100, taskid=7,
                lastmodifieddate=T(DAY + "10:15"))
    base.update(kw)
    return base


def task(**kw):
    base = dict(tier="archive", warehouse="whracks10", taskid=7, tasktype="Picking", taskname="Other", startdate=T(DAY + "09:00"),
                enddate=T(DAY + "12:00"))
    base.update(kw)
    return base


def log(worker, status, t, module="wave_picking", logid=1):
    return dict(warehouse="whracks10", logid=logid, emailaddress=worker, modulename=module, status=status,
                actiontime=T(DAY + t))


def test_second_branch_label(spark):
    roles = make_roles(spark, items=[item(item_table="qc")],
                       tasks=[task(tasktype="QCShipping"), task(tier="live", tasktype="QCShipping")])
    d = pick_detail(roles.items, roles.tasks, W)
    assert sorted(r.process for r in d.collect()) == ["Picking", "QC"]
    d = pick_detail(roles.items, roles.tasks, W, fix_labels=True)
    assert sorted(r.process for r in d.collect()) == ["QC", "QC"]


def test_pick_table_feeds_two_processes(spark):
    roles = make_roles(spark, items=[item(id=1, taskid=1), item(id=2, taskid=2)],
                       tasks=[task(taskid=1), task(taskid=2, tasktype="Conso", taskname="B2CConsoRackIn")])
    d = pick_detail(roles.items, roles.tasks, W)
    assert sorted((r.process) for r in d.collect()) == ["ConsoRacking", "Picking"]


def test_live_items_not_read(spark):
    roles = make_roles(spark, items=[item(tier="live")], tasks=[task()])
    assert pick_detail(roles.items, roles.tasks, W).count() == 0


def test_zero_and_missing_time(spark):
    items = [item(id=1, emailaddress="a", processquantity=4.0),  # time 0 -> 3600
             item(id=2, emailaddress="b", processquantity=0.0, notfoundquantity=1.0),  # Quantity 0, time 0 -> 0
             item(id=3, emailaddress="c", processquantity=2.0)]  # no time row -> 3600
    logs = [log("a", "in", "10:20", logid=1), log("a", "out", "10:20", logid=2),
            log("b", "in", "10:20", logid=3), log("b", "out", "10:20", logid=4)]
    roles = make_roles(spark, items=items, tasks=[task()], worklog=logs)
    raw = {r.emailaddress: r for r in hourly_pipeline(roles, W).collect()}
    assert raw["a"].working_sec == 3600.0 and raw["b"].working_sec == 0.0 and raw["c"].working_sec == 3600.0
    assert raw["a"].warehouse == "PNQ"
    only_b = make_roles(spark, items=[items[1]], tasks=[task()], worklog=logs[2:])
    h = hourly_report(hourly_pipeline(only_b, W)).collect()[0]
    assert h.QTY == 0.0 and h.EPH is None and h.Distinct_User == 1


def test_product_dedup_and_null_key(spark):
    prods = [dict(productid=100, brandid="b", productcatid="7", subcatid=1),
             dict(productid=100, brandid="b", productcatid="999", subcatid=2),
             dict(productid=None, brandid="n", productcatid="999", subcatid=1)]
    items = [item(id=1, emailaddress="a"), item(id=2, emailaddress="z", productid=None), item(id=3, emailaddress=None)]
    roles = make_roles(spark, items=items, tasks=[task()], productdetails=prods)
    raw = {r.emailaddress: r for r in hourly_pipeline(roles, W).collect()}
    assert set(raw) == {"a", "z"}  # NULL worker dropped
    assert (raw["a"].Quantity, raw["a"].BabyGear_Qty, raw["a"].QTY) == (5.0, 5.0, 5.0)
    assert (raw["z"].Consumable_Qty, raw["z"].QTY) == (5.0, 0.0)  # NULL productid pairs with NULL key


def test_hourly_sums_to_daily(spark):
    items = [item(id=i, emailaddress=w, lastmodifieddate=T(DAY + t)) for i, (w, t) in
             enumerate([("a", "09:05"), ("a", "10:10"), ("b", "10:40"), ("b", "11:50")])]
    logs = [log("a", "in", "09:01", logid=1), log("a", "out", "10:30", logid=2), log("b", "in", "10:00", logid=3)]
    roles = make_roles(spark, items=items, tasks=[task()], worklog=logs)
    raw = hourly_pipeline(roles, W)
    h = hourly_report(raw).agg(F.sum("QTY")).first()[0]
    d = daily_report(raw).collect()
    assert len(d) == 1 and d[0].QTY == h == 20.0 and d[0].Distinct_User == 2


def test_items_match_tasks_of_their_own_warehouse_only(spark):
    from opsmetrics.operators.items import process_items
    from opsmetrics.plans.sql_reports import sql_report
    from opsmetrics.spec import PICKING

    roles = make_roles(spark, items=[item(id=1), item(id=2, warehouse="whracks2")], tasks=[task(warehouse="whracks2")])
    assert [r.warehouse for r in pick_detail(roles.items, roles.tasks, W).collect()] == ["whracks2"]
    assert [r.id for r in process_items(roles.items, roles.tasks, PICKING, W).collect()] == [2]
    assert [r.warehouse for r in sql_report(spark, roles, "report_picking", W).collect()] == ["whracks2"]
