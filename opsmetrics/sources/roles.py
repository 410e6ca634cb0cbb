"""Role tables: the inputs every report is written against.

A role is one logical table (``items``, ``tasks``, ``worklog`` ...) with
``warehouse`` and ``tier`` as ordinary columns instead of one database
schema per warehouse and tier.  Stored as Parquet partitioned by those
columns, a filter on them becomes partition pruning and one plan covers
every warehouse.

``Roles`` is a lazy bundle: each role is resolved only when a report asks
for it, from a loader function (Parquet directory, JDBC, or the test
mapping in ``sources.testdata``).
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.windows import DAY

ROLE_NAMES = (
    "items",
    "tasks",
    "worklog",
    "productdetails",
    "ordermaster",
    "grc_g",
    "grc_m",
    "grc_i",
    "grc_v",
    "grc_pd",
)

# Column contract of each role (Spark DDL).  Writers of role tables and the
# test mapping both produce exactly these columns.
ROLE_SCHEMAS = {
    "items": (
        "item_table string, tier string, warehouse string, id bigint, emailaddress string, "
        "businesstype string, quantity double, processquantity double, notfoundquantity double, "
        "productid bigint, taskid bigint, poid bigint, whpoid bigint, binid bigint, "
        "whordertype string, lastmodifieddate timestamp_ntz"
    ),
    "tasks": (
        "tier string, warehouse string, taskid bigint, tasktype string, taskname string, "
        "startdate timestamp_ntz, enddate timestamp_ntz"
    ),
    "worklog": (
        "warehouse string, logid bigint, emailaddress string, modulename string, status string, "
        "actiontime timestamp_ntz"
    ),
    "productdetails": "productid bigint, brandid string, productcatid string, subcatid int",
    "ordermaster": "poid bigint, ordertype string",
    "grc_g": (
        "grcno bigint, pono bigint, invoiceno bigint, productid bigint, grcstatus string, "
        "createddate timestamp_ntz, createdby string, lastmodifieddate timestamp_ntz, "
        "lastmodifiedby string, mrp double, basecost double, srno bigint, orderedquantity double, "
        "invoicequantity double, totalreceivequantity double, extraquantity double, "
        "lessquantity double, rejectedquantity double, rtvreason string, onholdquantity double, "
        "onholdreason string, storeinquantity double, warehouseid int, inwardid bigint"
    ),
    "grc_m": "srno bigint, invreferenceid bigint, vendorcode bigint",
    "grc_i": "referenceid bigint",
    "grc_v": "vendorcode bigint, name string",
    "grc_pd": "referenceid bigint, grcno bigint, stickername string, createdby string, createddate timestamp_ntz",
}


class Roles:
    """Lazily resolved role DataFrames."""

    def __init__(self, spark: SparkSession, loaders: dict[str, Callable[[], DataFrame]]):
        self.spark = spark
        self._loaders = loaders
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in ROLE_NAMES:
            raise AttributeError(name)
        if name not in self._cache:
            if name not in self._loaders:
                raise KeyError(f"no loader for role {name!r}")
            self._cache[name] = self._loaders[name]()
        return self._cache[name]

    def fresh(self) -> "Roles":
        """The same roles, resolved anew: a loader that reads files lists them again."""
        return Roles(self.spark, self._loaders)

    def with_role(self, name: str, df: DataFrame) -> "Roles":
        loaders = dict(self._loaders)
        loaders[name] = lambda: df
        return Roles(self.spark, loaders)


def parquet_roles(spark: SparkSession, base: str) -> Roles:
    """Roles stored as ``{base}/{role}`` Parquet directories (any partitioning).

    Read with the role schema, so partition columns keep their declared
    types and column order is the contract's; a role that is laid out by
    day has the partition column ``DAY`` after them.
    """

    def loader(name: str) -> Callable[[], DataFrame]:
        schema = ROLE_SCHEMAS[name] + (f", {DAY} date" if DAY in ROLE_LAYOUT[name][0] else "")
        cols = [f.strip().split(" ")[0] for f in schema.split(",")]
        return lambda: spark.read.schema(schema).parquet(f"{base.rstrip('/')}/{name}").select(*cols)

    return Roles(spark, {n: loader(n) for n in ROLE_NAMES})


# How each role is laid out when stored: partition columns (pruned by the
# reports' process / tier / type filters) and the sort inside each file
# (so min/max statistics let the window filters skip row groups).
ROLE_LAYOUT = {
    "items": (("item_table", "tier", DAY), ("lastmodifieddate",)),
    "tasks": (("tier", "tasktype"), ("startdate",)),
    "worklog": ((DAY,), ("actiontime",)),
    "productdetails": ((), ("productid",)),
    "ordermaster": ((), ("poid",)),
    "grc_g": ((DAY,), ("lastmodifieddate",)),
    "grc_m": ((), ("srno",)),
    "grc_i": ((), ("referenceid",)),
    "grc_v": ((), ("vendorcode",)),
    "grc_pd": ((), ("referenceid",)),
}


# Rows that one task of ``store_role`` should sort: up to ``FEW`` parts (so many a shuffle writes without
# sorting) it is the first number, beyond them the second, so a task's memory does not grow with the table.
PART_ROWS, FEW, MOST_PART_ROWS = 200_000, 200, 1_000_000


def parts_for(rows: int) -> int:
    """Parts in which a table of so many rows is written."""
    return max(1, min(FEW, -(-rows // PART_ROWS)), -(-rows // MOST_PART_ROWS))


@contextmanager
def shuffles_removed(spark: SparkSession):
    """What is run inside has its shuffle files removed when it is done, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, was)


def laid_out(df: DataFrame, role: str, made: dict[str, Column] | None = None) -> DataFrame:
    """The role's rows in its layout (``ROLE_LAYOUT``), ``DAY`` last where it is laid out by day.

    Rows are dealt by ranges of the layout's order into parts of even row
    counts, so a part's sort stays in memory however large the table or one
    folder of it is.  A hash of the row stands last in the ranges: a stamp
    that many rows share is split too.

    With ``made``, ``df`` is a source and ``made`` has the role's columns
    over it, one row for each of its rows: the source's columns are dealt
    and sorted, and the role's, which are wider, are made as they are written.
    """
    parts, order = ROLE_LAYOUT[role]
    made = made or {c: F.col(c) for c in df.columns}
    columns = made | ({DAY: F.to_date(made[order[0]])} if DAY in parts else {})
    place = {c: f"{c} in the layout" for c in (*parts, *order)}
    dealt = df.repartitionByRange(parts_for(df.count()), *[columns[c] for c in place], F.xxhash64(*made.values()))
    dealt = dealt.withColumns({name: columns[c] for c, name in place.items()}).sortWithinPartitions(*place.values())
    return dealt.select(*[(F.col(place[c]) if c in place else column).alias(c) for c, column in columns.items()])


def store_role(df: DataFrame, path: str, role: str, mode: str = "overwrite", made: dict[str, Column] | None = None) -> None:
    """Write a role table in its layout (``laid_out``)."""
    with shuffles_removed(df.sparkSession):
        w = laid_out(df, role, made).write.mode(mode).option("compression", "zstd")
        if ROLE_LAYOUT[role][0]:
            w = w.partitionBy(*ROLE_LAYOUT[role][0])
        w.parquet(path)


@dataclass(frozen=True)
class JdbcSplit:
    """How a role's table is read by several connections: a number, date or timestamp column cut at even steps."""

    column: str
    lower: str
    upper: str
    partitions: int


def jdbc_options(url: str, table: str, split: JdbcSplit | None = None, fetch: int = 10_000) -> dict[str, str]:
    """Options of one role's JDBC read; rows outside the split's bounds go to its first and last part."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch), "pushDownPredicate": "true"}
    if split is not None:
        options |= {"partitionColumn": split.column, "lowerBound": split.lower, "upperBound": split.upper, "numPartitions": str(split.partitions)}
    return options


def as_role(df: DataFrame, role: str) -> DataFrame:
    """A loaded table with the role's columns and types (databases have their own number and time types)."""
    fields = [f.strip().split(" ") for f in ROLE_SCHEMAS[role].split(",")]
    return df.select(*[df[name].cast(kind).alias(name) for name, kind in fields])


def jdbc_roles(
    spark: SparkSession,
    url: str,
    tables: dict[str, str],
    properties: dict[str, str],
    splits: dict[str, JdbcSplit] | None = None,
) -> Roles:
    """Roles read over JDBC, one ``dbtable`` (or ``(subquery) alias``) per role, cast to the role schema.

    Filters and column selections of the reports are pushed into the
    database query by Spark's JDBC source.  A role named in ``splits`` is
    read in that many parts at once; without, by one connection.
    """

    def loader(role: str) -> Callable[[], DataFrame]:
        options = jdbc_options(url, tables[role], (splits or {}).get(role))
        return lambda: as_role(spark.read.format("jdbc").options(**options, **properties).load(), role)

    return Roles(spark, {role: loader(role) for role in tables})
