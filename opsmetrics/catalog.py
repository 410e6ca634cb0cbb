"""Operator-level queries: each building block of the reports on its own.

Every entry runs one operator (or a short chain ending in it) over the
role tables mapped from the provided test tables, and has a DuckDB
statement that states the same operator the way the source SQL/pandas
code does.  Keys follow SURVEY section 2.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .functions.labels import classify_module, warehouse_label
from .functions.measures import interval_seconds
from .functions.windows import ReportWindow, hour_bucket, in_window, micros_since, of_days, overlaps
from .operators.items import active, for_tasks, overlapping_tasks
from .operators.products import dedup_products, with_category
from .operators.sessions import log_filter, session_changes, working_time
from .operators.totals import worker_totals
from .plans import hourly, reports
from .sources.testdata import testdata_roles
from .spec import CONSO_RACKING, PICKING, all_modules

ITEM_COLS = (
    "item_table", "tier", "warehouse", "id", "emailaddress", "businesstype", "quantity", "processquantity",
    "notfoundquantity", "productid", "taskid", "lastmodifieddate",
)

# A week inside the month of the data, for the window and overlap operators: rows lie before, after and on both bounds.
WEEK = ReportWindow.of("2024-01-08 00:00:00", "2024-01-14 23:59:59")


def _items_sql_cols(prefix: str = "") -> str:
    return ", ".join(prefix + c for c in ITEM_COLS)


def build(window: ReportWindow) -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]]:
    w = window
    s, e = O.ts(w.start), O.ts(w.end)
    ws, we = O.ts(WEEK.start), O.ts(WEEK.end)
    R = testdata_roles
    out: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {}

    def reg(key: str, sql: str):
        def deco(fn):
            out[key] = (fn, sql)
            return fn

        return deco

    # F1 activity filter
    @reg("activity_filter", O.with_roles(["items"], f"""SELECT {_items_sql_cols()} FROM items
WHERE processquantity > 0 OR notfoundquantity > 0"""))
    def _(spark, d):
        return active(R(spark, d).items).select(*ITEM_COLS)

    # F2-F4 window bounds on the item / log stamps
    @reg("window_open", O.with_roles(["items"], f"""SELECT {_items_sql_cols()} FROM items
WHERE lastmodifieddate < {we} AND lastmodifieddate > {ws}"""))
    def _(spark, d):
        return of_days(R(spark, d).items, WEEK).where(in_window("lastmodifieddate", WEEK, "open")).select(*ITEM_COLS)

    @reg("window_half_open", O.with_roles(["items"], f"""SELECT {_items_sql_cols()} FROM items
WHERE lastmodifieddate < {we} AND lastmodifieddate >= {ws}"""))
    def _(spark, d):
        return of_days(R(spark, d).items, WEEK).where(in_window("lastmodifieddate", WEEK, "half_open")).select(*ITEM_COLS)

    @reg("window_closed", O.with_roles(["worklog"], f"""SELECT * FROM worklog
WHERE actiontime BETWEEN {ws} AND {we}"""))
    def _(spark, d):
        return of_days(R(spark, d).worklog, WEEK).where(in_window("actiontime", WEEK, "closed"))

    # F5 interval overlap, every task type
    @reg("interval_overlap", O.with_roles(["tasks"], f"""SELECT * FROM tasks WHERE {O.overlap_sql(WEEK)}"""))
    def _(spark, d):
        return R(spark, d).tasks.where(overlaps("startdate", "enddate", WEEK))

    # F6 (+F5) task type selection for one process
    @reg("task_type_filter", O.with_roles(["tasks"], f"""SELECT * FROM tasks
WHERE {O.task_sql(PICKING)} AND {O.overlap_sql(w)}"""))
    def _(spark, d):
        return overlapping_tasks(R(spark, d).tasks, PICKING, w)

    # F7 (+F5/F6) rack-in task names of consolidation racking
    @reg("task_name_filter", O.with_roles(["tasks"], f"""SELECT * FROM tasks
WHERE {O.task_sql(CONSO_RACKING)} AND {O.overlap_sql(w)}"""))
    def _(spark, d):
        return overlapping_tasks(R(spark, d).tasks, CONSO_RACKING, w)

    # F8/F9 work-log filter
    @reg("worklog_filter", O.with_roles(["worklog"], f"""SELECT * FROM worklog
WHERE actiontime BETWEEN {s} AND {e} AND status IN ('in', 'out') AND modulename IN ({O.q(PICKING.modules)})"""))
    def _(spark, d):
        return log_filter(R(spark, d).worklog, PICKING.modules, w)

    # F10 + W1 change filter per process
    dedup_sql = f"""SELECT warehouse, logid, emailaddress, modulename, status, actiontime, prev_to FROM (
  SELECT *, lag(status) OVER (PARTITION BY warehouse, emailaddress ORDER BY logid) AS prev_to
  FROM worklog
  WHERE actiontime BETWEEN {s} AND {e} AND status IN ('in', 'out') AND modulename IN ({{mods}})) t
WHERE prev_to IS NULL OR status <> prev_to"""

    @reg("session_dedup", O.with_roles(["worklog"], dedup_sql.format(mods=O.q(PICKING.modules))))
    def _(spark, d):
        return session_changes(R(spark, d).worklog, PICKING.modules, w)

    # W2 change filter across all processes (hourly form)
    @reg("session_dedup_hourly", O.with_roles(["worklog"], dedup_sql.format(mods=O.q(all_modules()))))
    def _(spark, d):
        return session_changes(R(spark, d).worklog, all_modules(), w)

    # The same with short blocks, so that most rows take their predecessor from another block, on two levels
    @reg("session_dedup_blocks", O.with_roles(["worklog"], dedup_sql.format(mods=O.q(all_modules()))))
    def _(spark, d):
        return session_changes(R(spark, d).worklog, all_modules(), w, block=32)

    # J1 semi join items -> overlapping tasks (same tier)
    @reg("task_semi_join", O.with_roles(["items", "tasks"], f"""SELECT {_items_sql_cols('i.')} FROM items i
WHERE EXISTS (
  SELECT 1 FROM tasks t WHERE t.tier = i.tier AND t.warehouse = i.warehouse AND t.taskid = i.taskid
    AND {O.task_sql(PICKING)} AND {O.overlap_sql(w, 't.startdate', 't.enddate')})"""))
    def _(spark, d):
        r = R(spark, d)
        return for_tasks(r.items, overlapping_tasks(r.tasks, PICKING, w)).select(*ITEM_COLS)

    # J2 left join to products (fan-out kept)
    @reg("product_left_join", O.with_roles(["items", "productdetails"], f"""SELECT i.id, i.tier, i.productid,
  i.processquantity, p.productcatid, p.subcatid
FROM items i LEFT JOIN productdetails p ON i.productid = p.productid"""))
    def _(spark, d):
        r = R(spark, d)
        it = r.items.select("id", "tier", "productid", "processquantity")
        p = r.productdetails.select("productid", "productcatid", "subcatid")
        return it.join(p, "productid", "left").select("id", "tier", "productid", "processquantity", "productcatid", "subcatid")

    # W3 product dedup
    prod_sql = """SELECT productid, brandid, productcatid, subcatid FROM (
  SELECT *, row_number() OVER (PARTITION BY productid ORDER BY subcatid, brandid, productcatid) AS rno
  FROM productdetails) x WHERE rno = 1"""

    @reg("product_dedup", O.with_roles(["productdetails"], prod_sql))
    def _(spark, d):
        return dedup_products(R(spark, d).productdetails)

    # J3 null-safe left join to deduplicated products
    @reg("product_natural_join", O.with_roles(["items", "productdetails"], f"""SELECT i.id, i.tier, i.productid,
  p.productcatid
FROM items i LEFT JOIN ({prod_sql}) p ON i.productid IS NOT DISTINCT FROM p.productid"""))
    def _(spark, d):
        r = R(spark, d)
        it = r.items.select("id", "tier", "productid")
        return with_category(it, dedup_products(r.productdetails), null_safe=True)

    # U1 + U3: DISTINCT per tier branch, UNION ALL
    @reg("branch_distinct", O.with_roles(["items", "tasks", "productdetails"], O.lines_sql(PICKING, w)))
    def _(spark, d):
        r = R(spark, d)
        return reports.report_lines(r, PICKING, w).drop("tier")

    @reg("live_archive_union", O.with_roles(["items"], """SELECT tier, warehouse, id, emailaddress, quantity FROM items
WHERE tier = 'live'
UNION ALL
SELECT tier, warehouse, id, emailaddress, quantity FROM items
WHERE tier = 'archive'"""))
    def _(spark, d):
        it = R(spark, d).items
        cols = ["tier", "warehouse", "id", "emailaddress", "quantity"]
        return it.where(F.col("tier") == "live").select(*cols).unionByName(it.where(F.col("tier") == "archive").select(*cols))

    # A1/A2 conditional sums per worker
    @reg("conditional_sums", O.with_roles(["items", "tasks", "productdetails"], f"""SELECT warehouse, emailaddress,
  SUM(processquantity) AS totalprocess, SUM(notfoundquantity) AS totalnotfound,
  SUM(CASE WHEN businesstype = 'B2B' THEN processquantity ELSE 0 END) AS b2b_qty,
  SUM(CASE WHEN businesstype = 'B2C' THEN processquantity ELSE 0 END) AS b2c_qty,
  SUM(CASE WHEN productcatid = '7' THEN processquantity ELSE 0 END) AS babygear_qty,
  SUM(CASE WHEN productcatid = '999' THEN processquantity ELSE 0 END) AS consumable_qty
FROM ({O.lines_sql(PICKING, w)}) g GROUP BY warehouse, emailaddress"""))
    def _(spark, d):
        lines = reports.report_lines(R(spark, d), PICKING, w)
        return worker_totals(lines, ["totalprocess", "totalnotfound", "b2b_qty", "b2c_qty", "babygear_qty", "consumable_qty"])

    # A10 + X6 + X8: working seconds per worker (SQL form, window correction)
    @reg("working_seconds", O.with_roles(["worklog"], f"""SELECT warehouse, emailaddress,
  CAST(total_us AS DOUBLE) / 1000000.0 AS total_working_seconds FROM ({O.time_sql(PICKING.modules, w)}) t"""))
    def _(spark, d):
        t = working_time(session_changes(R(spark, d).worklog, PICKING.modules, w), w)
        return t.select("warehouse", "emailaddress", "total_working_seconds")

    # A12 + X7 + X9: the interval form, registered in seconds (DuckDB has no SUM over intervals)
    @reg("working_interval", O.with_roles(["worklog"], f"""SELECT warehouse, emailaddress,
  CAST(total_us AS DOUBLE) / 1000000.0 AS interval_seconds FROM ({O.time_sql(PICKING.modules, w)}) t"""))
    def _(spark, d):
        t = working_time(session_changes(R(spark, d).worklog, PICKING.modules, w), w)
        return t.select("warehouse", "emailaddress", interval_seconds(F.col("total_working_hrs")).alias("interval_seconds"))

    # J5 worker-hour item rows left join working time on warehouse, process, hour and worker
    @reg("pick_time_join", O.with_roles(["items", "tasks", "productdetails", "worklog"], """SELECT pk.warehouse, pk.process,
  pk.timestamp, pk.emailaddress, pk.Quantity, CAST(tg.working_us AS DOUBLE) / 1000000.0 AS working_sec
FROM pk LEFT JOIN tg USING (warehouse, process, timestamp, emailaddress)""", O.raw_ctes(w)))
    def _(spark, d):
        r = R(spark, d)
        totals = hourly.item_totals(hourly.pick_detail(r.items, r.tasks, w), r.productdetails)
        j = hourly.with_time(totals, hourly.hourly_time(r.worklog, w))
        return j.select(*hourly.RAW_KEYS, "Quantity", (F.col("working_us").cast("double") / F.lit(1_000_000.0)).alias("working_sec"))

    # X1 module -> process
    @reg("process_classify", O.with_roles(["worklog"], f"""SELECT logid, modulename, {O._process_case()} AS process
FROM worklog"""))
    def _(spark, d):
        return R(spark, d).worklog.select("logid", "modulename", classify_module("modulename").alias("process"))

    # X2 warehouse labels (unmatched unchanged)
    @reg("warehouse_label", O.with_roles(["worklog"], f"""SELECT logid, warehouse, {O._label_case('warehouse')} AS label
FROM worklog"""))
    def _(spark, d):
        return R(spark, d).worklog.select("logid", "warehouse", warehouse_label("warehouse").alias("label"))

    # X11/X12/T3 hour bucket and seconds into the hour
    @reg("hour_bucket", O.with_roles(["worklog"], """SELECT logid, date_trunc('hour', actiontime) AS timestamp,
  CAST(date_diff('microsecond', date_trunc('hour', actiontime), actiontime) AS DOUBLE) / 1000000.0 AS diff_in_sec
FROM worklog"""))
    def _(spark, d):
        b = hour_bucket("actiontime")
        return R(spark, d).worklog.select(
            "logid", b.alias("timestamp"), (micros_since("actiontime", b).cast("double") / F.lit(1_000_000.0)).alias("diff_in_sec")
        )

    # O3 preview: first 10 rows of a report in report order (the limit is the feature)
    @reg("preview_top", O.report_sql("report_picking", w).replace(
        "ORDER BY src.warehouse, src.emailaddress", "ORDER BY src.warehouse, src.emailaddress LIMIT 10"))
    def _(spark, d):
        return reports.report(R(spark, d), "report_picking", w, hours_as="hours").limit(10)

    # S3 / U4: one plan over the six named warehouses
    @reg("multi_warehouse", O.report_sql("report_picking", w).replace(
        "ORDER BY src.warehouse", "WHERE src.warehouse IN ('whracks2', 'whracks7', 'whracks9', 'whracks10', "
        "'whracks11', 'whracks12')\nORDER BY src.warehouse"))
    def _(spark, d):
        whs = [f"whracks{i}" for i in (2, 7, 9, 10, 11, 12)]
        return reports.report(R(spark, d), "report_picking", w, warehouses=whs, hours_as="hours")

    return out
