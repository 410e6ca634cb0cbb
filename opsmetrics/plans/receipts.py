"""Goods-receipt report: receipts in a window with invoice, vendor and sticker details.

    grc_g (closed window on lastmodifieddate)
      LEFT JOIN grc_m  ON m.srno = g.inwardid
      LEFT JOIN grc_i  ON i.referenceid = m.invreferenceid
      LEFT JOIN grc_v  ON v.vendorcode = m.vendorcode
      LEFT JOIN grc_pd ON pd.referenceid = i.referenceid AND pd.grcno = g.grcno

All joins are left joins and keep their fan-out (two invoice details give
two rows).  The window filter sits on the scan of ``grc_g``; the join
strategy per step is left to Spark's size estimates and AQE.  All that the
joins ask of a receipt is its (inwardid, grcno): the chain runs over the
distinct pairs, and the receipts, which are wide, are shuffled once, to meet
its rows.  Receipts that are many for the session's shuffle partitions meet
them in runs of days, whose sorts fit in memory; the chain is shuffled once
for all runs.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import warehouse_id_label
from ..functions.windows import DAY, ReportWindow, in_window, of_days
from ..spec import GRC_ON_HOLD, GRN_NOT_DONE, NOT_ON_HOLD

# Stored bytes of the receipts (about a tenth of what they take in memory) that one task of their join should sort.
SORT_BYTES = 16 << 20
# Each run reads and sorts the chain again; where more runs were needed, the chain's own partitions are too large as well.
MOST_RUNS = 8


def runs_for(stored: int, partitions: int, days: int) -> int:
    """Runs of days in which receipts of so many stored bytes meet the chain."""
    needed = max(1, -(-stored // (SORT_BYTES * partitions)))
    return min(needed, days) if needed <= MOST_RUNS else 1


def in_runs(g: DataFrame, window: ReportWindow) -> list[DataFrame]:
    """The window's receipts: together, or in runs of days if they are laid out by day and too many for a sort in each partition."""
    closed = in_window("lastmodifieddate", window, "closed")
    rows = of_days(g, window).where(closed)
    if DAY not in g.columns or window.is_empty:
        return [rows]
    conf = g.sparkSession.conf
    partitions = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions")
    stored = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    days = (window.end.date() - window.start.date()).days + 1
    runs = runs_for(stored, int(partitions), days)
    if runs == 1:
        return [rows]
    at = [(days * k // runs, days * (k + 1) // runs - 1) for k in range(runs)]  # the first and the last day of each
    spans = [ReportWindow(window.start + dt.timedelta(days=a), window.start + dt.timedelta(days=b)) for a, b in at]
    return [of_days(g, span).where(closed) for span in spans]


def goods_receipts(
    g: DataFrame, m: DataFrame, i: DataFrame, v: DataFrame, pd: DataFrame, window: ReportWindow
) -> DataFrame:
    runs = in_runs(g, window)
    g = of_days(g, window).where(in_window("lastmodifieddate", window, "closed"))
    pairs = g.select("inwardid", "grcno").distinct().alias("k")
    m = m.select("srno", "invreferenceid", "vendorcode").alias("m")
    i = i.select("referenceid").alias("i")
    v = v.select("vendorcode", "name").alias("v")
    pd = pd.select("referenceid", "grcno", "stickername", "createdby", "createddate").alias("pd")
    c = F.col
    found = (
        pairs.join(m, c("m.srno") == c("k.inwardid"), "left")
        .join(i, c("i.referenceid") == c("m.invreferenceid"), "left")
        .join(v, c("v.vendorcode") == c("m.vendorcode"), "left")
        .join(pd, (c("pd.referenceid") == c("i.referenceid")) & (c("k.grcno") == c("pd.grcno")), "left")
    )
    found = found.select("k.inwardid", "k.grcno", "i.referenceid", "v.name", "pd.stickername", "pd.createdby", "pd.createddate")
    return reduce(DataFrame.union, [_with_details(run, found) for run in runs])


def _with_details(g: DataFrame, found: DataFrame) -> DataFrame:
    """The report's columns of receipts and what the joins found of their pairs."""
    c = F.col
    # Every receipt has its pair, a NULL in it included.
    j = g.alias("g").join(found.alias("d"), c("d.inwardid").eqNullSafe(c("g.inwardid")) & c("d.grcno").eqNullSafe(c("g.grcno")))
    on_hold = c("g.grcstatus") == GRC_ON_HOLD
    stored = c("g.storeinquantity") > 0
    return j.select(
        c("d.referenceid").alias("Reference No"),
        c("g.grcno").alias("GRC No"),
        c("g.pono").alias("PO No"),
        c("g.invoiceno").alias("Invoice No"),
        c("g.productid").alias("Product ID"),
        c("g.grcstatus").alias("GRC Status"),
        c("d.name").alias("Vendor Name"),
        c("g.createddate").alias("GRC Created Date"),
        c("g.createdby").alias("GRC Created By"),
        c("g.lastmodifieddate").alias("Last Modified Date"),
        c("g.lastmodifiedby").alias("Last Modified By"),
        c("d.stickername").alias("Product Sticker Name"),
        c("g.mrp").alias("MRP"),
        c("g.basecost").alias("Base Cost"),
        c("g.srno").alias("SR No"),
        c("g.orderedquantity").alias("Ordered Qty"),
        c("g.invoicequantity").alias("Invoice Qty"),
        c("g.totalreceivequantity").alias("Total Received Qty"),
        c("g.extraquantity").alias("Extra Qty"),
        c("g.lessquantity").alias("Less Qty"),
        c("g.rejectedquantity").alias("Rejected Qty"),
        c("g.rtvreason").alias("RTV Reason"),
        c("g.onholdquantity").alias("On Hold Qty"),
        c("g.onholdreason").alias("On Hold Reason"),
        c("g.storeinquantity").alias("Store In Qty"),
        F.when(on_hold, c("g.lastmodifiedby")).otherwise(F.lit(NOT_ON_HOLD)).alias("On Hold By"),
        F.when(on_hold, c("g.lastmodifieddate")).alias("On Hold Date"),
        F.when(stored, c("d.createdby")).otherwise(F.lit(GRN_NOT_DONE)).alias("GRN Done By"),
        F.when(stored, c("d.createddate")).alias("GRN Date"),
        warehouse_id_label(c("g.warehouseid")).alias("Warehouse"),
    )


def grc_report(roles, window: ReportWindow) -> DataFrame:
    return goods_receipts(roles.grc_g, roles.grc_m, roles.grc_i, roles.grc_v, roles.grc_pd, window)
