"""Catch-up: many hourly windows in one plan, each with the results of a run of its own.

A load that has fallen behind would run once for every missed hour, and
each run's change filter sees only its own window's log.  Here the log and
the items meet a table of windows (``operators.intervals``) and every later step has
the window among its keys: ``lag`` starts anew in each window, tasks are
tested against the item's window, totals and times are kept apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import classify_module
from ..operators.intervals import WINDOW_KEYS, in_either, stamps_in_windows
from ..operators.items import active_predicate
from ..operators.sessions import DEFAULT_BLOCK, hourly_working_time, previous_in_order
from ..spec import ALL_SPECS, STATUS_IN, STATUS_OUT, all_modules
from .hourly import DETAIL_COLS, any_process, process_rows, productivity_raw, tier_flags

KEYS = list(WINDOW_KEYS)


def windows_time(worklog: DataFrame, windows: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """``sessions.hourly_time`` of each window, with the window's bounds."""
    log = worklog.where(F.col("status").isin(STATUS_IN, STATUS_OUT) & F.col("modulename").isin(*all_modules()))
    log = stamps_in_windows(log, "actiontime", windows, "closed").withColumn("process", classify_module("modulename"))
    log = previous_in_order(log, [*KEYS, "warehouse", "emailaddress"], "logid", "status", "prev_to", block)
    return hourly_working_time(log.where(~F.col("status").eqNullSafe(F.col("prev_to"))), KEYS)


def windows_detail(items: DataFrame, tasks: DataFrame, windows: DataFrame, fix_labels: bool = False) -> DataFrame:
    """``hourly.pick_detail`` of each window, with the window's bounds.

    Only the tasks that an item of the window names are tested against it,
    by an equality join: tasks without items never meet a window.
    """
    wanted = F.col("item_table").isin(*sorted({s.item_table for s in ALL_SPECS})) & (F.col("tier") == "archive") & active_predicate()
    it = stamps_in_windows(items.where(wanted).drop("tier"), "lastmodifieddate", windows, "half_open")
    keys = ["warehouse", "taskid"]
    named = it.select(*KEYS, *keys).distinct()
    held = tasks.where(any_process(ALL_SPECS)).join(named, keys).where(in_either("startdate", "enddate"))
    rows = it.join(tier_flags(held, [*KEYS, *keys]), [*KEYS, *keys]).withColumn("process", process_rows(ALL_SPECS, fix_labels))
    return rows.select(*KEYS, *DETAIL_COLS)


def catch_up(roles, windows: DataFrame, fix_labels: bool = False, block: int = DEFAULT_BLOCK) -> DataFrame:
    """The worker-hour rows (``hourly.productivity_raw``) of every window of the table, as a run for each would give them."""
    detail = windows_detail(roles.items, roles.tasks, windows, fix_labels)
    return productivity_raw(detail, roles.productdetails, windows_time(roles.worklog, windows, block), KEYS)
