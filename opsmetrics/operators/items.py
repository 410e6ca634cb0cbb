"""Item-line operators: activity filter, task selection, tiers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.windows import ReportWindow, in_window, of_days, overlaps
from ..spec import ProcessSpec


def active_predicate() -> Column:
    # NULL OR TRUE is TRUE: a NULL processquantity still passes on a not-found count.
    return (F.col("processquantity") > 0) | (F.col("notfoundquantity") > 0)


def active(items: DataFrame) -> DataFrame:
    """Lines that processed something or reported something not found."""
    return items.where(active_predicate())


def task_predicate(spec: ProcessSpec) -> Column:
    cond = F.col("tasktype") == spec.tasktype
    if spec.tasknames is not None:
        cond = cond & F.col("taskname").isin(*spec.tasknames)
    return cond


def overlapping_tasks(tasks: DataFrame, spec: ProcessSpec, window: ReportWindow) -> DataFrame:
    """Tasks of the process's type (and names) that overlap the report window."""
    return tasks.where(task_predicate(spec) & overlaps("startdate", "enddate", window))


def for_tasks(items: DataFrame, tasks: DataFrame, keys: Iterable[str] | None = None) -> DataFrame:
    """Items whose task is among ``tasks`` (``taskid IN (...)`` as a left semi join).

    Join keys: ``taskid`` plus ``tier``/``warehouse`` when both sides carry
    them.  No DISTINCT is needed on the task side: a semi join emits each
    item at most once.  Spark chooses broadcast or shuffle from the
    measured size of the filtered task side.
    """
    if keys is None:
        keys = ["taskid"] + [k for k in ("tier", "warehouse") if k in items.columns and k in tasks.columns]
    keys = list(keys)
    return items.join(tasks.select(*keys), keys, "left_semi")


def process_items(
    items: DataFrame,
    tasks: DataFrame,
    spec: ProcessSpec,
    window: ReportWindow,
    bounds: str = "open",
    tiers: Iterable[str] | None = None,
) -> DataFrame:
    """Active item lines of one process inside the window whose task overlaps it."""
    cond = (F.col("item_table") == spec.item_table) & active_predicate() & in_window("lastmodifieddate", window, bounds)
    if tiers is not None:
        cond = cond & F.col("tier").isin(*tiers)
    return for_tasks(of_days(items, window).where(cond), overlapping_tasks(tasks, spec, window))


def branch_distinct(lines: DataFrame, cols: Iterable[str]) -> DataFrame:
    """``SELECT DISTINCT cols`` per tier branch, then UNION ALL of the branches.

    Keeping ``tier`` (and ``warehouse``) in the DISTINCT key gives exactly
    one DISTINCT per branch followed by a bag union: a line present in
    both tiers is counted twice.  The DISTINCT is a two-phase hash
    aggregate, so copies collapse map-side before the shuffle.
    """
    keys = [c for c in ("warehouse", "tier") if c in lines.columns]
    return lines.select(*keys, *[c for c in cols if c not in keys]).distinct()


def one_line_per_id(lines: DataFrame) -> DataFrame:
    """One line for each item id of a warehouse: the archive line before the live one, then the smallest.

    A minimum over a struct, combined before the shuffle.
    """
    rest = [c for c in lines.columns if c not in ("warehouse", "id")]
    first = F.min(F.struct(*sorted(rest, key=lambda c: c != "tier"))).alias("_line")  # 'archive' sorts before 'live'
    return lines.groupBy("warehouse", "id").agg(first).select("warehouse", "id", "_line.*").select(*lines.columns)
