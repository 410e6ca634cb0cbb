"""Classification and labelling expressions (all JVM-side CASE chains)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import MODULE_PROCESS, OTHER_PROCESS, WAREHOUSE_ID_LABELS, WAREHOUSE_LABELS


def classify_module(col: str | Column = "modulename") -> Column:
    """Log module -> process name; unknown modules become ``Others``."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for process, modules in MODULE_PROCESS:
        cond = c.isin(*modules)
        expr = F.when(cond, F.lit(process)) if expr is None else expr.when(cond, F.lit(process))
    return expr.otherwise(F.lit(OTHER_PROCESS))


def warehouse_label(col: str | Column = "warehouse") -> Column:
    """Schema name -> short label by exact match; other values pass unchanged."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for name, label in WAREHOUSE_LABELS.items():
        expr = F.when(c == name, F.lit(label)) if expr is None else expr.when(c == name, F.lit(label))
    return expr.otherwise(c)


def label_warehouse(df: DataFrame, col: str = "warehouse") -> DataFrame:
    return df.withColumn(col, warehouse_label(col))


def warehouse_id_label(col: str | Column = "warehouseid") -> Column:
    """Numeric warehouse id -> name; no ELSE branch, so unmatched ids are NULL."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for wid, label in WAREHOUSE_ID_LABELS.items():
        expr = F.when(c == wid, F.lit(label)) if expr is None else expr.when(c == wid, F.lit(label))
    return expr
