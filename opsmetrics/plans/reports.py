"""Per-worker productivity reports over a window (five v1 and four v2 reports).

Each report is one Spark plan over all warehouses at once:

    items --filter(process, activity, open window)--> semi join overlapping tasks
          --> DISTINCT per tier --> LEFT JOIN product categories --> GROUP BY worker   (src)
    worklog --filter(closed window, in/out, modules)--> change filter
          --> signed offset sums per worker, negative-corrected              (tgt)
    src LEFT JOIN tgt ON (warehouse, worker) --> rates --> ORDER BY worker

The reports differ only in the process spec, the extra DISTINCT columns
and the output list, which are data (``REPORTS``).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import per_hour
from ..functions.windows import ReportWindow
from ..operators.items import branch_distinct, one_line_per_id, process_items
from ..operators.products import product_categories, with_category
from ..operators.sessions import DEFAULT_BLOCK, session_changes, working_time
from ..operators.totals import packing_totals, worker_totals
from ..sources.roles import Roles
from ..spec import CONSO_PICKING, CONSO_RACKING, PACKING, PICKING, QC, ProcessSpec

LINE_COLS = ("id", "emailaddress", "businesstype", "quantity", "processquantity", "notfoundquantity", "productid")
KEYS = ("warehouse", "emailaddress")


@dataclass(frozen=True)
class ReportDef:
    key: str
    spec: ProcessSpec
    version: int
    # (output name, source): source is a measure name, or one of
    # "date" (S as text), "hrs" (working time), "warehouse",
    # ("eph", measure) rounded rate, ("minus", a, b).
    outputs: tuple
    extra: tuple[str, ...] = ()  # extra DISTINCT columns (v2)
    packing: bool = False  # joins the order master


def _v1(key: str, spec: ProcessSpec, date_col: str, b2b: str, b2c: str, eph: str) -> ReportDef:
    return ReportDef(
        key,
        spec,
        1,
        (
            ("emailaddress", "emailaddress"),
            (date_col, "date"),
            ("totalnotfound", "totalnotfound"),
            (b2b, "b2b_qty"),
            (b2c, "b2c_qty"),
            ("total_picking_qty", "totalprocess"),
            ("total_working_hrs", "hrs"),
            (eph, ("eph", "totalprocess")),
            ("babygear_qty", "babygear_qty"),
            ("consumable_qty", "consumable_qty"),
            ("warehouse", "warehouse"),
        ),
    )


REPORTS: dict[str, ReportDef] = {
    d.key: d
    for d in (
        _v1("report_picking", PICKING, "picking_date", "b2b_picking_qty", "b2c_picking_qty", "picking_eph"),
        _v1("report_conso_picking", CONSO_PICKING, "conso_picking_date", "b2b_qty", "b2c_qty", "eph"),
        _v1("report_conso_racking", CONSO_RACKING, "conso_racking_date", "b2b_qty", "b2c_qty", "eph"),
        # The v1 packing report names its date column conso_picking_date.
        _v1("report_packing", PACKING, "conso_picking_date", "b2b_qty", "b2c_qty", "eph"),
        _v1("report_qc", QC, "qc_date", "b2b_qty", "b2c_qty", "eph"),
        ReportDef(
            "report_conso_picking_v2",
            CONSO_PICKING,
            2,
            (
                ("emailaddress", "emailaddress"),
                ("consopick_startdate", "date"),
                ("no_of_orders", "ordercount"),
                ("total_working_hrs", "hrs"),
                ("eph_orders", ("eph", "ordercount")),
                ("warehouse", "warehouse"),
            ),
            extra=("poid", "whpoid"),
        ),
        ReportDef(
            "report_conso_racking_v2",
            CONSO_RACKING,
            2,
            (
                ("emailaddress", "emailaddress"),
                ("consorack_date", "date"),
                ("notfound_qty", "totalnotfound"),
                ("b2b_qty", "b2b_qty"),
                ("b2c_qty", "b2c_qty"),
                ("total_picking_qty", "totalprocess"),
                ("total_working_hrs", "hrs"),
                ("eph_quantity", ("eph", "totalprocess")),
                ("warehouse", "warehouse"),
            ),
            extra=("poid",),
        ),
        ReportDef(
            "report_qc_v2",
            QC,
            2,
            (
                ("emailaddress", "emailaddress"),
                ("qc_date", "date"),
                ("single_whpo", "single_whpo"),
                ("multiple_whpo", ("minus", "whpo_count", "single_whpo")),
                ("total_orders", "whpo_count"),
                ("total_qty", "totalprocess"),
                ("total_working_hrs", "hrs"),
                ("eph_orders", ("eph", "whpo_count")),
                ("eph_quantity", ("eph", "totalprocess")),
                ("warehouse", "warehouse"),
            ),
            extra=("poid", "whpoid", "whordertype"),
        ),
        ReportDef(
            "report_packing_v2",
            PACKING,
            2,
            (
                ("emailaddress", "emailaddress"),
                ("packing_date", "date"),
                ("no_of_totes", "bin_count"),
                ("total_qty", "totalprocess"),
                ("total_working_hrs", "hrs"),
                ("eph_qty", ("eph", "totalprocess")),
                ("total_tagged_qty", "total_tagged_qty"),
                ("total_non_tagged_qty", "total_non_tagged_qty"),
                ("babygear_qty", "babygear_qty"),
                ("free_sample_qty", "consumable_qty"),
                ("warehouse", "warehouse"),
            ),
            extra=("poid", "whpoid", "binid"),
            packing=True,
        ),
    )
}

# (process, version) -> report key
BY_PROCESS = {(d.spec.process, d.version): k for k, d in REPORTS.items()}


def _measures_needed(d: ReportDef) -> list[str]:
    out: list[str] = []
    for _, src in d.outputs:
        names = [src] if isinstance(src, str) else list(src[1:])
        for n in names:
            if n not in ("date", "hrs", "warehouse", "emailaddress") and n not in out:
                out.append(n)
    return out


def report_lines(
    roles: Roles,
    spec: ProcessSpec,
    window: ReportWindow,
    extra: Iterable[str] = (),
    warehouses: Iterable[str] | None = None,
    dedup: bool = False,
) -> DataFrame:
    """Distinct item lines of one process with their product category (fan-out kept).

    A line in both tiers counts twice, as in the source; with ``dedup``
    an id counts once, its archive line if there is one.
    """
    items = roles.items
    if warehouses is not None:
        items = items.where(F.col("warehouse").isin(*list(warehouses)))
    lines = process_items(items, roles.tasks, spec, window, "open")
    # DISTINCT before the category join: DISTINCT(items) JOIN DISTINCT(categories)
    # equals DISTINCT(items JOIN products), with fewer rows through the join.
    lines = branch_distinct(lines, (*LINE_COLS, *extra))
    if dedup:
        lines = one_line_per_id(lines)
    return with_category(lines, product_categories(roles.productdetails))


def report_time(
    roles: Roles,
    spec: ProcessSpec,
    window: ReportWindow,
    warehouses: Iterable[str] | None = None,
    block: int = DEFAULT_BLOCK,
) -> DataFrame:
    """Working time per (warehouse, worker) for the process's modules."""
    log = roles.worklog
    if warehouses is not None:
        log = log.where(F.col("warehouse").isin(*list(warehouses)))
    return working_time(session_changes(log, spec.modules, window, KEYS, block), window, KEYS)


def _hours(hours_as: str) -> Column:
    if hours_as == "interval":
        return F.col("total_working_hrs")
    if hours_as == "hours":
        return F.col("total_working_us").cast("double") / F.lit(3_600_000_000.0)
    if hours_as == "seconds":
        return F.col("total_working_seconds")
    raise ValueError(f"unknown hours_as {hours_as!r}")


def report(
    roles: Roles,
    key: str,
    window: ReportWindow,
    warehouses: Iterable[str] | None = None,
    hours_as: str = "interval",
    order: bool = True,
    block: int = DEFAULT_BLOCK,
    dedup: bool = False,
    distinct_single: bool = False,
) -> DataFrame:
    """Run report ``key`` (see ``REPORTS``) for a window.

    ``warehouses`` restricts the warehouses (all when None);
    ``hours_as`` renders total_working_hrs as an ``interval`` (as the
    source does), decimal ``hours`` or ``seconds``.  Two variants depart
    from the source: ``dedup`` counts an item that stands in both tiers
    once, ``distinct_single`` counts distinct single orders in place of
    their rows, so that the multiple orders cannot become negative.
    """
    d = REPORTS[key]
    whs = list(warehouses) if warehouses is not None else None
    lines = report_lines(roles, d.spec, window, d.extra, whs, dedup)
    needed = _measures_needed(d)
    if d.packing:
        src = packing_totals(lines, roles.ordermaster, KEYS)
    else:
        src = worker_totals(lines, needed, KEYS, distinct_single)
    tgt = report_time(roles, d.spec, window, whs, block)
    j = src.join(tgt, list(KEYS), "left")

    cols: list[Column] = []
    for name, source in d.outputs:
        if source == "date":
            c = F.lit(window.start_text)
        elif source == "hrs":
            c = _hours(hours_as)
        elif isinstance(source, tuple) and source[0] == "eph":
            c = per_hour(F.col(source[1]), F.col("total_working_seconds"), 2)
        elif isinstance(source, tuple) and source[0] == "minus":
            c = F.col(source[1]) - F.col(source[2])
        else:
            c = F.col(source)
        cols.append(c.alias(name))
    out = j.select(*cols)
    if order:
        out = out.orderBy(F.col("warehouse").asc_nulls_last(), F.col("emailaddress").asc_nulls_last())
    return out
