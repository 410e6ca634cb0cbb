"""Work-log sessions: change filter, working time per worker, per hour.

The in/out log is de-duplicated with ``lag(status)`` per worker in logid
order: a row is kept when its status differs from the previous row's.
A plain window would sort every row of a worker in one task, so a single
worker holding a large share of the log would become one huge task.
``previous_in_order`` therefore splits each worker's log into blocks of
the order key: ``lag`` runs per (worker, block), and only the first and
last rows of the blocks go on to a second step, where a block's first row
takes the last value of the worker's block before it (in blocks of blocks,
so sparse log ids cannot make that step large either).  The whole log is
scanned and shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import classify_module
from ..functions.measures import exact_sum, micros_to_interval, micros_to_seconds
from ..functions.windows import ReportWindow, hour_bucket, in_window, micros_since, of_days
from ..spec import HOUR_SECONDS, STATUS_IN, STATUS_OUT, all_modules

# Width of an order-key block: bounds the rows one window task sorts per worker.
DEFAULT_BLOCK = 1 << 20
# Block levels: 2 keeps the block-carry step bounded even for sparse order keys.
DEFAULT_LEVELS = 2
# Rows whose order key is NULL sort last, in this many blocks: their order among themselves is free.
_LAST_BLOCK, _LAST_BLOCKS = 1 << 62, 4096


def _blocked_lag(d: DataFrame, grp: str, blk: str, order: Sequence[Column], value: str, out: str, block: int, level: int) -> DataFrame:
    """``out`` = the previous row's value within ``grp``; ``d`` is dealt by (grp, blk) once.

    Rows inside a block take it from their block's window.  A block's first
    and last rows (at most two) go on as the edges: there the first row
    finds the last row of the block before it, one level up.  Both parts
    read the same exchange, with all columns, so it is made only once.
    """
    prev, rn, nxt, up = (f"_{n}_{level}" for n in ("prev", "rn", "next", "up"))
    w = Window.partitionBy(grp, blk).orderBy(*order)
    d = d.withColumns({prev: F.lag(value).over(w), rn: F.row_number().over(w), nxt: F.lead(F.lit(1)).over(w)})
    inner = d.where(F.col(rn) > 1).withColumn(out, F.col(prev))
    edges = d.where((F.col(rn) == 1) | F.col(nxt).isNull())
    along = (F.col(blk).asc(), F.col(rn).asc())
    if level > 1:
        edges = edges.withColumn(up, F.expr(f"`{blk}` div {int(block)}"))
        edges = _blocked_lag(edges, grp, up, along, value, out, block, level - 1).drop(up)
    else:
        edges = edges.withColumn(out, F.lag(value).over(Window.partitionBy(grp).orderBy(*along)))
    return inner.unionByName(edges.where(F.col(rn) == 1)).drop(prev, rn, nxt)


def previous_in_order(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    out: str,
    block: int = DEFAULT_BLOCK,
    levels: int | None = None,
) -> DataFrame:
    """``lag(value) OVER (PARTITION BY keys ORDER BY order NULLS LAST)`` as ``out``, skew-safe.

    The log is dealt once by (key, block of ``block`` order values) and
    ``lag`` runs there.  Only a block's first and last rows are dealt again,
    by blocks of blocks (``levels`` times in all), so even with sparse
    order values no task sorts more than about ``2 * block`` rows per
    level; the top level is a plain window over what is left.  Rows of
    one order value follow each other by their other columns, rows
    without an order value come last, spread over blocks by a hash.
    """
    levels = DEFAULT_LEVELS if levels is None else levels
    ties = [F.col(c).asc_nulls_last() for c in df.columns if c != order and c not in keys]
    # A struct key: NULL keys still make a group.
    d = df.withColumn("_grp", F.struct(*[F.col(k) for k in keys]))
    last = F.lit(_LAST_BLOCK) + F.pmod(F.xxhash64(*df.columns), F.lit(_LAST_BLOCKS))
    d = d.withColumn("_blk", F.coalesce(F.expr(f"`{order}` div {int(block)}"), last))
    made = _blocked_lag(d, "_grp", "_blk", (F.col(order).asc_nulls_last(), *ties), value, out, block, levels)
    return made.drop("_grp", "_blk")


def log_filter(worklog: DataFrame, modules: Iterable[str], window: ReportWindow) -> DataFrame:
    """Log rows inside the closed window, status in/out, one of the modules."""
    return of_days(worklog, window).where(
        in_window("actiontime", window, "closed")
        & F.col("status").isin(STATUS_IN, STATUS_OUT)
        & F.col("modulename").isin(*modules)
    )


def session_changes(
    worklog: DataFrame,
    modules: Iterable[str],
    window: ReportWindow,
    partition: Sequence[str] = ("warehouse", "emailaddress"),
    block: int = DEFAULT_BLOCK,
) -> DataFrame:
    """Filtered log rows whose status differs from the previous row's (NULL previous counts as different).

    ``partition`` is per warehouse and worker; the module list decides
    whether this is per process (reports) or across processes (hourly).
    """
    log = log_filter(worklog, modules, window)
    log = previous_in_order(log, list(partition), "logid", "status", "prev_to", block)
    return log.where(~F.col("status").eqNullSafe(F.col("prev_to")))


def _signed(status_value: str, v: Column, zero: bool) -> Column:
    c = F.when(F.col("status") == status_value, v)
    return c.otherwise(F.lit(0)) if zero else c


def working_time(changes: DataFrame, window: ReportWindow, keys: Sequence[str] = ("warehouse", "emailaddress")) -> DataFrame:
    """Working time per worker over a report window.

    SUM(out offsets) - SUM(in offsets), offsets measured from S.  A worker
    with only in-rows or only out-rows gets NULL (a SUM over no rows).  A
    negative total (the worker was already in at S) is corrected by adding
    the window length E - S.  Returns keys + ``total_working_us`` (exact
    decimal microseconds), ``total_working_seconds`` (double) and
    ``total_working_hrs`` (interval).
    """
    us = micros_since("actiontime", window.s())
    g = changes.groupBy(*keys).agg(
        (exact_sum(_signed(STATUS_OUT, us, False)) - exact_sum(_signed(STATUS_IN, us, False))).alias("_us")
    )
    total = F.when(F.col("_us") < 0, F.col("_us") + F.lit(window.length_micros)).otherwise(F.col("_us"))
    return g.select(
        *keys,
        total.cast("decimal(38,0)").alias("total_working_us"),
        micros_to_seconds(total).alias("total_working_seconds"),
        micros_to_interval(total).alias("total_working_hrs"),
    )


def hourly_working_time(changes: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Working time per warehouse, process, hour bucket and worker (and the ``more`` keys, such as a window's).

    Offsets are measured from the start of each row's hour; a side with no
    rows counts as 0, and a negative result gets one hour added.  Rows of
    a NULL worker are dropped (they can never be matched).
    """
    bucket = hour_bucket("actiontime")
    us = micros_since("actiontime", bucket)
    g = (
        changes.where(F.col("emailaddress").isNotNull())
        .withColumn("timestamp", bucket)
        .groupBy(*more, "warehouse", "process", "timestamp", "emailaddress")
        .agg((exact_sum(_signed(STATUS_OUT, us, True)) - exact_sum(_signed(STATUS_IN, us, True))).alias("_us"))
    )
    return corrected_hours(g, more)


def corrected_hours(sums: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Signed microseconds ``_us`` of each hour and worker as working time: a negative sum gets one hour added."""
    hour_us = HOUR_SECONDS * 1_000_000
    total = F.when(F.col("_us") < 0, F.col("_us") + F.lit(hour_us)).otherwise(F.col("_us"))
    return sums.select(
        *more,
        "warehouse",
        "process",
        "timestamp",
        "emailaddress",
        total.cast("decimal(38,0)").alias("working_us"),
        micros_to_seconds(total).alias("working_sec"),
    )


def hourly_time(worklog: DataFrame, window: ReportWindow, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Hourly working time of every process (one plan over all warehouses).

    The change filter runs across all five processes together, per
    warehouse and worker; the process is the classified module of each row.
    """
    log = worklog.withColumn("process", classify_module("modulename"))
    changes = session_changes(log, all_modules(), window, ("warehouse", "emailaddress"), block)
    return hourly_working_time(changes)
