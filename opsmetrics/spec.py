"""Process specifications and other fixed values.

The five warehouse processes differ only in constants: which item table
they read, which task type (and task names) select their tasks, and
which log modules count as working time for them.  Every report is
driven from one ``ProcessSpec``.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# These must equal the values the source reports use.
# ---------------------------------------------------------------------------

PICKING_MODULES = (
    "wave_picking",
    "orderbasepicking",
    "b2c_orderbasepicking",
    "b2b_orderbasepicking",
    "mark_bin_close",
    "rack_wise_wave_picking",
)
QC_MODULES = ("qc_shipping", "qc-shipping")
CONSO_PICKING_MODULES = ("b2c_pick_completed_orders", "b2c_not_found_list")
CONSO_RACKING_MODULES = (
    "b2c_consolidate_orders",
    "b2b_consolidate_orders",
    "b2c_add_excess_items",
    "b2b_add_excess_items",
    "b2b_consolidate_orders_b2b",
)
PACKING_MODULES = ("bin/box_packing", "b2b_packing")

RACK_IN_TASK_NAMES = ("B2CExcessRackIn", "B2BExcessRackIn", "B2BConsoRackIn", "B2CConsoRackIn")

# Module -> process, first match wins, anything else is "Others".
MODULE_PROCESS = (
    ("Picking", PICKING_MODULES),
    ("QC", QC_MODULES),
    ("ConsoPicking", CONSO_PICKING_MODULES),
    ("ConsoRacking", CONSO_RACKING_MODULES),
    ("Packing", PACKING_MODULES),
)
OTHER_PROCESS = "Others"

# Warehouse schema name -> short label (hourly tables); unmatched names stay as they are.
WAREHOUSE_LABELS = {
    "whracks2": "CHKN",
    "whracks7": "BLR",
    "whracks9": "HRN",
    "whracks10": "PNQ",
    "whracks11": "FRQ",
    "whracks12": "INDR",
}

# Numeric warehouse id -> label (goods-receipt report); unmatched ids become NULL.
WAREHOUSE_ID_LABELS = {
    2: "CHAKAN",
    7: "BANGALORE",
    9: "HARYANA",
    10: "PNQ",
    11: "FRQ",
    12: "INDORE",
}

WAREHOUSE_IDS = (2, 7, 9, 10, 11, 12)

BUSINESS_B2B = "B2B"
BUSINESS_B2C = "B2C"
CATEGORY_BABY_GEAR = "7"
CATEGORY_CONSUMABLE = "999"
ORDER_TAGGED = "tagged"
ORDER_NON_TAGGED = "nontagged"
WHORDER_SINGLE = "Single"
STATUS_IN = "in"
STATUS_OUT = "out"
GRC_ON_HOLD = "grconhold"
NOT_ON_HOLD = "Not On Hold"
GRN_NOT_DONE = "GRN Not Done"

# Label the hourly feed puts on its second (live task master) branch, whatever the process.
SECOND_BRANCH_LABEL = "Picking"

HOUR_SECONDS = 3600


@dataclass(frozen=True)
class ProcessSpec:
    process: str
    item_table: str
    tasktype: str
    modules: tuple[str, ...]
    tasknames: tuple[str, ...] | None = None  # None: any task name


PICKING = ProcessSpec("Picking", "pick", "Picking", PICKING_MODULES)
CONSO_PICKING = ProcessSpec("ConsoPicking", "conso", "ConsoOut", CONSO_PICKING_MODULES)
CONSO_RACKING = ProcessSpec("ConsoRacking", "pick", "Conso", CONSO_RACKING_MODULES, RACK_IN_TASK_NAMES)
QC = ProcessSpec("QC", "qc", "QCShipping", QC_MODULES)
PACKING = ProcessSpec("Packing", "packing", "Packing", PACKING_MODULES)

# Order in which the hourly feed visits the processes.
ALL_SPECS = (PICKING, CONSO_PICKING, CONSO_RACKING, QC, PACKING)
SPECS = {s.process: s for s in ALL_SPECS}


def all_modules() -> tuple[str, ...]:
    out: list[str] = []
    for _, mods in MODULE_PROCESS:
        out.extend(mods)
    return tuple(out)
