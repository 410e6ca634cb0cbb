"""Per-worker totals over report lines (hash aggregate with map-side combine)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import (
    BUSINESS_B2B,
    BUSINESS_B2C,
    CATEGORY_BABY_GEAR,
    CATEGORY_CONSUMABLE,
    ORDER_NON_TAGGED,
    ORDER_TAGGED,
    WHORDER_SINGLE,
)


def when_else_zero(cond: Column, value: Column) -> Column:
    """CASE WHEN cond THEN value ELSE 0 END (a NULL cond takes the ELSE)."""
    return F.when(cond, value).otherwise(F.lit(0))


def _pq() -> Column:
    return F.col("processquantity")


def measures() -> dict[str, Column]:
    """Every measure a report can ask for, by output name."""
    PQ = _pq()
    return {
        "totalpick": F.sum("quantity"),
        "totalprocess": F.sum("processquantity"),
        "totalnotfound": F.sum("notfoundquantity"),
        "b2b_qty": F.sum(when_else_zero(F.col("businesstype") == BUSINESS_B2B, PQ).cast("double")),
        "b2c_qty": F.sum(when_else_zero(F.col("businesstype") == BUSINESS_B2C, PQ).cast("double")),
        "babygear_qty": F.sum(when_else_zero(F.col("productcatid") == CATEGORY_BABY_GEAR, PQ).cast("double")),
        "consumable_qty": F.sum(when_else_zero(F.col("productcatid") == CATEGORY_CONSUMABLE, PQ).cast("double")),
        "ordercount": F.countDistinct("poid"),
        "whpo_count": F.countDistinct("whpoid"),
        "single_whpo": F.sum(when_else_zero(F.col("whordertype") == WHORDER_SINGLE, F.lit(1))).cast("bigint"),
        "bin_count": F.countDistinct("binid"),
    }


def worker_totals(
    lines: DataFrame, names: Iterable[str], keys: Sequence[str] = ("warehouse", "emailaddress"), distinct_single: bool = False
) -> DataFrame:
    """GROUP BY worker with the named measures; ``distinct_single`` counts single orders by id, not by row."""
    m = measures()
    if distinct_single:
        m["single_whpo"] = F.countDistinct(F.when(F.col("whordertype") == WHORDER_SINGLE, F.col("whpoid")))
    return lines.groupBy(*keys).agg(*[m[name].alias(name) for name in names])


def order_type_counts(ordermaster: DataFrame) -> DataFrame:
    """Per poid: number of order-master rows, and how many are tagged / non-tagged.

    Aggregating the order master first turns the many-to-many LEFT JOIN
    on poid into a many-to-one join; the fan-out a duplicated poid would
    cause is re-applied as a multiplicity in ``packing_totals``.
    """
    t = F.col("ordertype")
    return ordermaster.groupBy("poid").agg(
        F.count(F.lit(1)).alias("_om_n"),
        F.sum(when_else_zero(t == ORDER_TAGGED, F.lit(1))).alias("_om_tagged"),
        F.sum(when_else_zero(t == ORDER_NON_TAGGED, F.lit(1))).alias("_om_nontagged"),
    )


def packing_totals(lines: DataFrame, ordermaster: DataFrame, keys: Sequence[str] = ("warehouse", "emailaddress")) -> DataFrame:
    """Packing measures, equal to aggregating ``lines LEFT JOIN ordermaster USING (poid)``.

    Each line would appear ``n`` times (n = matching order-master rows, 1 if
    none); a sum over those copies is the line's value times n, and a
    conditional sum by order type counts only the matching copies (with a
    0 from each other copy, so a NULL quantity still leaves a 0 when some
    copy falls in the ELSE branch).  Distinct counts ignore copies.
    """
    PQ = _pq()
    om = order_type_counts(ordermaster)
    j = lines.join(om, "poid", "left")
    n = F.coalesce(F.col("_om_n"), F.lit(1)).cast("double")
    nt = F.coalesce(F.col("_om_tagged"), F.lit(0))
    nn = F.coalesce(F.col("_om_nontagged"), F.lit(0))
    nlong = F.coalesce(F.col("_om_n"), F.lit(1))

    def by_type(k: Column) -> Column:
        return F.when((k > 0) & PQ.isNotNull(), PQ * k.cast("double")).when(nlong > k, F.lit(0.0))

    cat7 = when_else_zero(F.col("productcatid") == CATEGORY_BABY_GEAR, PQ).cast("double")
    cat999 = when_else_zero(F.col("productcatid") == CATEGORY_CONSUMABLE, PQ).cast("double")
    return j.groupBy(*keys).agg(
        F.sum(PQ * n).alias("totalprocess"),
        F.sum(cat7 * n).alias("babygear_qty"),
        F.sum(cat999 * n).alias("consumable_qty"),
        F.sum(by_type(nt)).alias("total_tagged_qty"),
        F.sum(by_type(nn)).alias("total_non_tagged_qty"),
        F.countDistinct("binid").alias("bin_count"),
    )
