import datetime as dt

from conftest import T, make_roles, role_df

from opsmetrics.functions.labels import classify_module, warehouse_id_label, warehouse_label
from opsmetrics.functions.windows import ReportWindow
from opsmetrics.plans import receipts
from opsmetrics.plans.receipts import grc_report
from opsmetrics.sources.roles import parquet_roles, store_role

W = ReportWindow.of("2024-01-10 00:00:00", "2024-01-10 23:59:59")


def g(**kw):
    base = dict(grcno=1, inwardid=10, grcstatus="grcdone", lastmodifieddate=T("2024-01-10 12:00"), lastmodifiedby="m1",
                storeinquantity=5.0, warehouseid=2)
    base.update(kw)
    return base


def test_receipts(spark):
    roles = make_roles(
        spark,
        grc_g=[g(grcno=1, grcstatus="grconhold"), g(grcno=2, storeinquantity=0.0), g(grcno=3, storeinquantity=None),
               g(grcno=4, inwardid=99, warehouseid=5), g(grcno=5), g(grcno=6, lastmodifieddate=T("2024-01-11 00:00"))],
        grc_m=[dict(srno=10, invreferenceid=500, vendorcode=None)],
        grc_i=[dict(referenceid=500)],
        grc_pd=[dict(referenceid=500, grcno=1, createdby="p1", createddate=T("2024-01-09 00:00")),
                dict(referenceid=500, grcno=5, createdby="p5", createddate=T("2024-01-09 00:00")),
                dict(referenceid=500, grcno=5, createdby="p6", createddate=T("2024-01-09 00:00"))],
    )
    rows = grc_report(roles, W).collect()
    by = {}
    for r in rows:
        by.setdefault(r["GRC No"], []).append(r)
    assert 6 not in by and len(by[5]) == 2  # outside the window; two invoice details -> two rows
    assert by[1][0]["On Hold By"] == "m1" and by[1][0]["On Hold Date"] is not None
    assert by[2][0]["On Hold By"] == "Not On Hold" and by[2][0]["On Hold Date"] is None
    assert by[2][0]["GRN Done By"] == "GRN Not Done" and by[2][0]["GRN Date"] is None
    assert by[3][0]["GRN Done By"] == "GRN Not Done"
    assert by[4][0]["GRN Done By"] is None and by[4][0]["GRN Date"] is None  # stored, no invoice detail
    assert by[4][0]["Warehouse"] is None and by[1][0]["Warehouse"] == "CHAKAN"
    assert by[1][0]["Vendor Name"] is None


def test_labels(spark):
    df = spark.createDataFrame([("whracks2", 2, "wave_picking"), ("whracks3", 5, "login"), ("whracks12", 12, "qc-shipping")],
                               "warehouse string, wid int, m string")
    got = [tuple(r) for r in df.select(warehouse_label("warehouse"), warehouse_id_label("wid"), classify_module("m")).collect()]
    assert got == [("CHKN", "CHAKAN", "Picking"), ("whracks3", None, "Others"), ("INDR", "INDORE", "QC")]


def test_joins_keep_null_keys_and_copies(spark):
    at = T("2024-01-10 10:00")
    g = [dict(grcno=n, inwardid=i, invoiceno=k, lastmodifieddate=at) for k, (n, i) in enumerate([(1, 1), (1, 1), (None, 1), (1, None), (None, None), (2, 1), (9, 9)])]
    m = [dict(srno=1, invreferenceid=5, vendorcode=3), dict(srno=1, invreferenceid=6, vendorcode=None), dict(srno=None, invreferenceid=5, vendorcode=3)]
    roles = make_roles(spark, grc_g=g, grc_m=m, grc_i=[dict(referenceid=5), dict(referenceid=5), dict(referenceid=None)], grc_v=[dict(vendorcode=3, name="v"), dict(vendorcode=None, name="n")],
                       grc_pd=[dict(referenceid=5, grcno=1, stickername="a"), dict(referenceid=5, grcno=1, stickername="b"), dict(referenceid=5, grcno=None, stickername="c")])
    got = [(r["Invoice No"], r["Reference No"], r["Vendor Name"], r["Product Sticker Name"]) for r in grc_report(roles, W).collect()]
    want = []
    for k in (0, 1):  # two invoices of number 5 with two details each, one row of the second master line
        want += [(k, 5, "v", s) for s in "ab"] * 2 + [(k, None, None, None)]
    for k in (2, 5):  # no detail has their number
        want += [(k, 5, "v", None)] * 2 + [(k, None, None, None)]
    want += [(k, None, None, None) for k in (3, 4, 6)]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_receipts_are_shuffled_once(spark):
    at = T("2024-01-10 10:00")
    roles = make_roles(spark, grc_g=[dict(grcno=1, inwardid=1, mrp=2.0, lastmodifieddate=at)])
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = grc_report(roles, W)
        plan = df._jdf.queryExecution().sparkPlan().toString()
        df.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    joins = [x for x in plan.splitlines() if "SortMergeJoin" in x]
    assert len(joins) == 5 and "Inner" in joins[0] and all("LeftOuter" in x for x in joins[1:]), plan


def _stored(spark, folder, **tables):
    """Roles of these rows, the receipts stored by day."""
    roles = make_roles(spark, **tables)
    store_role(role_df(spark, "grc_g", tables["grc_g"]), f"{folder}/grc_g", "grc_g")
    return roles.with_role("grc_g", parquet_roles(spark, str(folder)).grc_g)


def test_runs_follow_the_stored_bytes():
    full = receipts.SORT_BYTES * 200
    assert [receipts.runs_for(n, 200, 31) for n in (0, 1, full, full + 1, 8 * full, 8 * full + 1)] == [1, 1, 1, 2, 8, 1]
    assert receipts.runs_for(8 * full, 200, 3) == 3 and receipts.runs_for(2 * full, 400, 31) == 1


def test_runs_of_days_share_the_chain(spark, tmp_path, monkeypatch):
    w = ReportWindow.of("2024-01-02 12:00:00", "2024-01-08 12:00:00")
    first = T("2024-01-01 00:00")
    g = [dict(grcno=None if k % 11 == 0 else k % 9, inwardid=None if k % 13 == 0 else k % 7, invoiceno=k, storeinquantity=1.0, lastmodifieddate=None if k == 50 else first + dt.timedelta(hours=2 * k)) for k in range(120)]
    g += [dict(grcno=1, inwardid=1, invoiceno=1000 + k, lastmodifieddate=at) for k, at in enumerate([w.start, w.end, T("2024-01-02 11:59:59"), T("2024-01-08 12:00:01"), T("2024-01-05 00:00"), T("2024-01-04 23:59:59"), w.start])]
    m = [dict(srno=k, invreferenceid=100 + k % 3, vendorcode=k % 2) for k in (1, 2, 2, 3, 4, 5)]
    pd = [dict(referenceid=100 + k % 3, grcno=k % 9, stickername=f"s{k}", createdby="c") for k in range(40)]
    roles = _stored(spark, tmp_path, grc_g=g, grc_m=m, grc_i=[dict(referenceid=101), dict(referenceid=102)], grc_v=[dict(vendorcode=1, name="v")], grc_pd=pd)
    whole = sorted(map(repr, grc_report(roles, w).collect()))
    monkeypatch.setattr(receipts, "runs_for", lambda stored, partitions, days: min(3, days))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = grc_report(roles, w)
        got = sorted(map(repr, df.collect()))
        tree = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert got == whole and len({r.split("Invoice No=")[1].split(",")[0] for r in got}) > 70
    assert tree.count("SortMergeJoin") == 3 + 4 and tree.count("ReusedExchange") == 2, tree  # the chain's four joins once
    one = ReportWindow.of("2024-01-05 00:00:00", "2024-01-05 23:59:59")
    assert len(receipts.in_runs(roles.grc_g, one)) == 1 and len(receipts.in_runs(roles.grc_g, w)) == 3
    runs = [r.select("invoiceno").collect() for r in receipts.in_runs(roles.grc_g, w)]
    assert all(runs) and sum(map(len, runs)) == sum(1 for x in g if x["lastmodifieddate"] and w.start <= x["lastmodifieddate"] <= w.end)


def test_sizes_of_stored_receipts_make_runs(spark, tmp_path, monkeypatch):
    w = ReportWindow.of("2024-01-01 00:00:00", "2024-01-31 23:59:59")
    roles = _stored(spark, tmp_path, grc_g=[dict(grcno=k, inwardid=k, lastmodifieddate=T("2024-01-01 00:00") + dt.timedelta(hours=k)) for k in range(700)])
    assert len(receipts.in_runs(roles.grc_g, w)) == 1
    size = int(str(roles.grc_g._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    monkeypatch.setattr(receipts, "SORT_BYTES", max(1, size // (5 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    assert 4 <= len(receipts.in_runs(roles.grc_g, w)) <= 8
    assert sorted(r["GRC No"] for r in grc_report(roles, w).collect()) == list(range(700))
