"""Column expressions: windows, labels, rates."""

from .labels import classify_module, label_warehouse, warehouse_id_label, warehouse_label
from .measures import exact_sum, micros_to_interval, micros_to_seconds, per_hour
from .windows import ReportWindow, hour_bucket, in_window, micros_since, next_window, overlaps, ts_lit

__all__ = [
    "ReportWindow",
    "classify_module",
    "exact_sum",
    "hour_bucket",
    "in_window",
    "label_warehouse",
    "micros_since",
    "micros_to_interval",
    "micros_to_seconds",
    "next_window",
    "overlaps",
    "per_hour",
    "ts_lit",
    "warehouse_id_label",
    "warehouse_label",
]
