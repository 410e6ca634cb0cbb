"""The v1 reports as one parameterised Spark SQL statement.

For users who run SQL: the window bounds, process constants and the
role table names are named parameters (``:s``, ``:e``,
``IDENTIFIER(:items)`` ...), never text substitution, so a bound can not
rewrite another bound or a table name.  Bounds are passed as text and
read with ``to_timestamp_ntz`` (no time zone involved).  The statement has the same shape
as the DataFrame plan, including the two-level block-split ``lag`` that
keeps one busy worker's log from landing in a single task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions.windows import ReportWindow, of_days
from ..operators.sessions import DEFAULT_BLOCK
from ..sources.roles import Roles
from .reports import REPORTS

V1_REPORT_SQL = """
WITH tk AS (
  SELECT tier, warehouse, taskid FROM IDENTIFIER(:tasks)
  WHERE tasktype = :tasktype
    AND (:any_taskname OR array_contains(:tasknames, taskname))
    AND (startdate BETWEEN to_timestamp_ntz(:s) AND to_timestamp_ntz(:e)
         OR enddate BETWEEN to_timestamp_ntz(:s) AND to_timestamp_ntz(:e)
         OR to_timestamp_ntz(:s) BETWEEN startdate AND enddate
         OR to_timestamp_ntz(:e) BETWEEN startdate AND enddate)
),
lines AS (
  SELECT DISTINCT warehouse, tier, id, emailaddress, businesstype, quantity, processquantity,
         notfoundquantity, productid
  FROM IDENTIFIER(:items) it
  LEFT SEMI JOIN tk USING (tier, warehouse, taskid)
  WHERE it.item_table = :item_table
    AND (it.processquantity > 0 OR it.notfoundquantity > 0)
    AND it.lastmodifieddate > to_timestamp_ntz(:s) AND it.lastmodifieddate < to_timestamp_ntz(:e)
),
cats AS (SELECT DISTINCT productid, productcatid FROM IDENTIFIER(:products)),
src AS (
  SELECT warehouse, emailaddress,
    SUM(processquantity) AS totalprocess,
    SUM(notfoundquantity) AS totalnotfound,
    SUM(CAST(CASE WHEN businesstype = 'B2B' THEN processquantity ELSE 0 END AS DOUBLE)) AS b2b_qty,
    SUM(CAST(CASE WHEN businesstype = 'B2C' THEN processquantity ELSE 0 END AS DOUBLE)) AS b2c_qty,
    SUM(CAST(CASE WHEN productcatid = '7' THEN processquantity ELSE 0 END AS DOUBLE)) AS babygear_qty,
    SUM(CAST(CASE WHEN productcatid = '999' THEN processquantity ELSE 0 END AS DOUBLE)) AS consumable_qty
  FROM lines LEFT JOIN cats USING (productid)
  GROUP BY warehouse, emailaddress
),
lg AS (
  SELECT named_struct('warehouse', warehouse, 'emailaddress', emailaddress) AS grp,
         coalesce(logid DIV :block, 4611686018427387904 + pmod(xxhash64(status, actiontime), 4096)) AS blk,
         warehouse, emailaddress, logid, status, actiontime
  FROM IDENTIFIER(:worklog)
  WHERE actiontime BETWEEN to_timestamp_ntz(:s) AND to_timestamp_ntz(:e)
    AND status IN ('in', 'out') AND array_contains(:modules, modulename)
),
lagged AS (
  SELECT *, lag(status) OVER blk_order AS prev, row_number() OVER blk_order AS rn, lead(1) OVER blk_order AS nxt
  FROM lg WINDOW blk_order AS (PARTITION BY grp, blk ORDER BY logid NULLS LAST, status, actiontime)
),
edges AS (
  SELECT *, lag(status) OVER up_order AS prev2, row_number() OVER up_order AS rn2, lead(1) OVER up_order AS nxt2
  FROM (SELECT *, blk DIV :block AS up FROM lagged WHERE rn = 1 OR nxt IS NULL)
  WINDOW up_order AS (PARTITION BY grp, up ORDER BY blk, rn)
),
tops AS (
  SELECT *, lag(status) OVER (PARTITION BY grp ORDER BY up, rn2) AS prev3 FROM edges WHERE rn2 = 1 OR nxt2 IS NULL
),
turns AS (
  SELECT warehouse, emailaddress, status, actiontime, prev FROM lagged WHERE rn > 1
  UNION ALL SELECT warehouse, emailaddress, status, actiontime, prev2 FROM edges WHERE rn = 1 AND rn2 > 1
  UNION ALL SELECT warehouse, emailaddress, status, actiontime, prev3 FROM tops WHERE rn = 1 AND rn2 = 1
),
changes AS (
  SELECT * FROM turns WHERE NOT (status <=> prev)
),
wt AS (
  SELECT warehouse, emailaddress,
    SUM(CAST(CASE WHEN status = 'out' THEN timestampdiff(MICROSECOND, to_timestamp_ntz(:s), actiontime) END
             AS DECIMAL(38,0)))
    - SUM(CAST(CASE WHEN status = 'in' THEN timestampdiff(MICROSECOND, to_timestamp_ntz(:s), actiontime) END
               AS DECIMAL(38,0))) AS us
  FROM changes GROUP BY warehouse, emailaddress
),
tgt AS (
  SELECT warehouse, emailaddress, CASE WHEN us < 0 THEN us + :window_us ELSE us END AS total_us FROM wt
)
SELECT src.emailaddress,
  :start_text AS report_date,
  src.totalnotfound, src.b2b_qty, src.b2c_qty,
  src.totalprocess AS total_picking_qty,
  CAST(tgt.total_us AS DOUBLE) / 3600000000.0D AS total_working_hrs,
  CAST(round(CAST(try_divide(src.totalprocess, CAST(tgt.total_us AS DOUBLE) / 1000000.0D) * 60.0D * 60.0D
             AS DECIMAL(38,10)), 2) AS DOUBLE) AS eph,
  src.babygear_qty, src.consumable_qty, src.warehouse
FROM src LEFT JOIN tgt ON src.warehouse = tgt.warehouse AND src.emailaddress = tgt.emailaddress
ORDER BY src.warehouse NULLS LAST, src.emailaddress NULLS LAST
"""


def sql_report(
    spark: SparkSession,
    roles: Roles,
    key: str,
    window: ReportWindow,
    block: int = DEFAULT_BLOCK,
) -> DataFrame:
    """Run a v1 report through Spark SQL with named parameters; columns named as ``report``'s.

    The role tables are exposed as temporary views with names unique to
    this call (concurrent calls cannot see each other's views) and dropped
    once the statement is analysed.
    """
    d = REPORTS[key]
    if d.version != 1:
        raise ValueError("the SQL form covers the v1 reports")
    tag = uuid.uuid4().hex[:12]
    views = {}
    for role in ("items", "tasks", "productdetails", "worklog"):
        name = f"opsm_{role}_{tag}"
        df = getattr(roles, role)
        (of_days(df, window) if role in ("items", "worklog") else df).createOrReplaceTempView(name)
        views[role] = name
    spec = d.spec
    args = {
        "items": views["items"],
        "tasks": views["tasks"],
        "products": views["productdetails"],
        "worklog": views["worklog"],
        "s": window.start.isoformat(sep=" "),
        "e": window.end.isoformat(sep=" "),
        "start_text": window.start_text,
        "window_us": window.length_micros,
        "block": block,
        "item_table": spec.item_table,
        "tasktype": spec.tasktype,
        "any_taskname": spec.tasknames is None,
        "tasknames": list(spec.tasknames or ("",)),
        "modules": list(spec.modules),
    }
    try:
        out = spark.sql(V1_REPORT_SQL, args=args)  # analysed here: the views are resolved into the plan
    finally:
        for name in views.values():
            spark.catalog.dropTempView(name)
    # The source names some columns per report (date, B2B/B2C, rate).
    names = [n for n, _ in d.outputs]
    return out.toDF(*names)
