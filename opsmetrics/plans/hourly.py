"""Hourly and daily productivity per warehouse and process.

    worklog --(all process modules, closed window)--> change filter per (warehouse, worker)
            --> per (warehouse, process, hour, worker) signed offsets            hourly_time
    items (archive tier) --(activity, half-open window)--> JOIN task flags of the same warehouse
            --> one row per process and matching task tier, labelled                         pick_detail
    pick_detail --> hour bucket --> null-safe LEFT JOIN deduplicated products
            --> GROUP BY (warehouse, process, hour, worker) --> LEFT JOIN hourly_time
            --> fill missing / zero time, label warehouses                       productivity_raw
    productivity_raw --> GROUP BY hour | date                                    hourly_report / daily_report

The item feed is one scan of the items table for all five processes: the
two task-master branches of every process become one join on
(warehouse, taskid) against per-task tier flags, and the process follows
from the item table and the task type after it (the ``pick`` table feeds
two processes).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import warehouse_label
from ..functions.measures import exact_sum, micros_to_seconds, per_hour
from ..functions.windows import ReportWindow, hour_bucket, in_window, of_days, overlaps
from ..operators.items import active_predicate, task_predicate
from ..operators.products import dedup_products, with_category
from ..operators.sessions import DEFAULT_BLOCK, hourly_time
from ..spec import (
    ALL_SPECS,
    BUSINESS_B2B,
    BUSINESS_B2C,
    CATEGORY_BABY_GEAR,
    CATEGORY_CONSUMABLE,
    HOUR_SECONDS,
    SECOND_BRANCH_LABEL,
    ProcessSpec,
)

DETAIL_COLS = (
    "emailaddress",
    "businesstype",
    "quantity",
    "processquantity",
    "notfoundquantity",
    "productid",
    "lastmodifieddate",
    "process",
    "warehouse",
)
RAW_KEYS = ("warehouse", "process", "timestamp", "emailaddress")
HOUR_US = HOUR_SECONDS * 1_000_000

__all__ = [
    "hourly_time",
    "pick_detail",
    "productivity_raw",
    "hourly_report",
    "daily_report",
    "hourly_pipeline",
]


def pick_detail(
    items: DataFrame,
    tasks: DataFrame,
    window: ReportWindow,
    specs: Sequence[ProcessSpec] = ALL_SPECS,
    fix_labels: bool = False,
    item_tiers: Iterable[str] = ("archive",),
    dedup: bool = False,
) -> DataFrame:
    """Item lines of every process in [S, E), one row per task master holding the task.

    For each process the source takes archive items whose task is in the
    archive master (labelled with the process) UNION ALL archive items whose
    task is in the live master (labelled ``Picking`` whatever the process;
    ``fix_labels=True`` uses the process instead).  No DISTINCT: a task in
    both masters yields two rows; ``dedup=True`` keeps one of them for each
    item and process, the archive master's.
    """
    specs = list(specs)
    it = of_days(items, window).where(
        F.col("item_table").isin(*sorted({s.item_table for s in specs}))
        & F.col("tier").isin(*list(item_tiers))
        & active_predicate()
        & in_window("lastmodifieddate", window, "half_open")
    ).drop("tier")

    keys = [k for k in ("warehouse", "taskid") if k in tasks.columns]
    flags = tier_flags(tasks.where(any_process(specs) & overlaps("startdate", "enddate", window)), keys)
    if dedup:  # an item that several copies of the table hold counts once
        it = it.dropDuplicates(["warehouse", "item_table", "id"])
    rows = it.join(flags, keys, "inner").withColumn("process", process_rows(specs, fix_labels, dedup))
    return rows.select(*DETAIL_COLS)


def any_process(specs: Sequence[ProcessSpec]) -> Column:
    """Tasks of one of the processes."""
    return reduce(lambda a, b: a | b, [task_predicate(s) for s in specs])


def tier_flags(tasks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For each key and task type, which of the two masters hold such a task."""
    return tasks.groupBy(*keys, "tasktype").agg(
        F.max(F.col("tier") == "archive").alias("_in_archive"),
        F.max(F.col("tier") == "live").alias("_in_live"),
    )


def process_rows(specs: Sequence[ProcessSpec], fix_labels: bool, dedup: bool = False) -> Column:
    """The process labels of an item that has met its task's flags: a row for each process and master.

    The process follows from (item table, task type) and is given after
    the join, so no item is doubled before the shuffle.
    """
    labels = []
    for s in specs:
        own = (F.col("item_table") == s.item_table) & (F.col("tasktype") == s.tasktype)
        labels.append(F.when(own & F.col("_in_archive"), F.lit(s.process)))
        second = own & F.col("_in_live") & ~F.col("_in_archive") if dedup else own & F.col("_in_live")
        labels.append(F.when(second, F.lit(s.process if fix_labels else SECOND_BRANCH_LABEL)))
    return F.explode(F.array_compact(F.array(*labels)))


def _zero_sum(cond: Column, v: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, v).otherwise(F.lit(0.0))), F.lit(0.0))


def item_totals(detail: DataFrame, products: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Item totals per warehouse, process, hour and worker (and the ``more`` keys); rows of a NULL worker are dropped, all-missing sums are 0."""
    d = detail.where(F.col("emailaddress").isNotNull()).withColumn("timestamp", hour_bucket("lastmodifieddate"))
    d = with_category(d, dedup_products(products), null_safe=True)
    return d.groupBy(*more, *RAW_KEYS).agg(*item_sums())


def item_sums() -> list[Column]:
    """The totals of item rows with their categories, as sums that may also run over a stream."""
    pq = F.col("processquantity")
    return [
        F.coalesce(F.sum(pq), F.lit(0.0)).alias("Quantity"),
        F.coalesce(F.sum("notfoundquantity"), F.lit(0.0)).alias("totalnotfound"),
        _zero_sum(F.col("businesstype") == BUSINESS_B2B, pq).alias("B2B_Qty"),
        _zero_sum(F.col("businesstype") == BUSINESS_B2C, pq).alias("B2C_Qty"),
        _zero_sum(F.col("productcatid") == CATEGORY_BABY_GEAR, pq).alias("BabyGear_Qty"),
        _zero_sum(F.col("productcatid") == CATEGORY_CONSUMABLE, pq).alias("Consumable_Qty"),
    ]


def with_time(totals: DataFrame, time: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Item totals left join working time (``working_us``, NULL where the worker has none in that hour)."""
    return totals.join(time.select(*more, *RAW_KEYS, "working_us"), [*more, *RAW_KEYS], "left")


def productivity_raw(detail: DataFrame, products: DataFrame, time: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Worker-hour rows: item totals joined to working time.

    Rows of a NULL worker are dropped (a dataframe group-by drops missing
    keys) and all-missing sums are 0.  Missing working time becomes one hour,
    and so does zero time against a positive quantity.  Warehouse names get
    their short labels; QTY = Quantity - Consumable_Qty.  ``working_us``
    (exact microseconds) is kept for the roll-ups.
    """
    j = with_time(item_totals(detail, products, more), time, more)
    ws = F.col("working_us")
    filled = (
        F.when(ws.isNull(), F.lit(HOUR_US))
        .when((F.col("Quantity") > 0) & (ws == 0), F.lit(HOUR_US))
        .otherwise(ws)
        .cast("decimal(38,0)")
    )
    return j.select(
        *more,
        warehouse_label("warehouse").alias("warehouse"),
        "process",
        "timestamp",
        "emailaddress",
        "Quantity",
        "totalnotfound",
        "B2B_Qty",
        "B2C_Qty",
        "BabyGear_Qty",
        "Consumable_Qty",
        micros_to_seconds(filled).alias("working_sec"),
        (F.col("Quantity") - F.col("Consumable_Qty")).alias("QTY"),
        filled.alias("working_us"),
    )


def _rollup(raw: DataFrame, keys: Sequence[str]) -> DataFrame:
    g = raw.groupBy(*keys).agg(
        F.sum("QTY").alias("QTY"),
        exact_sum(F.col("working_us")).alias("_us"),
        F.countDistinct("emailaddress").alias("Distinct_User"),
    )
    return g.withColumn("EPH", per_hour(F.col("QTY"), micros_to_seconds(F.col("_us")), None, (float(HOUR_SECONDS),)))


def hourly_report(raw: DataFrame) -> DataFrame:
    """warehouse, process, timestamp, QTY, EPH (unrounded), Distinct_User."""
    return _rollup(raw, ("warehouse", "process", "timestamp")).select(
        "warehouse", "process", "timestamp", "QTY", "EPH", "Distinct_User"
    )


def daily_report(raw: DataFrame) -> DataFrame:
    """warehouse, process, date, QTY, Distinct_User, EPH — from the worker-hour rows, not the hourly table."""
    r = raw.withColumn("date", F.to_date("timestamp"))
    return _rollup(r, ("warehouse", "process", "date")).select("warehouse", "process", "date", "QTY", "Distinct_User", "EPH")


def hourly_pipeline(roles, window: ReportWindow, fix_labels: bool = False, block: int = DEFAULT_BLOCK) -> DataFrame:
    """productivity_raw for one window from the role tables."""
    time = hourly_time(roles.worklog, window, block)
    detail = pick_detail(roles.items, roles.tasks, window, fix_labels=fix_labels)
    return productivity_raw(detail, roles.productdetails, time)
