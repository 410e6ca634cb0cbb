"""Tables that change together: every commit is one small file that names the folders of all of them.

    base/_commits/000000000007.json     version 7: table -> key -> folder, and the load's own notes
    base/raw/v7-<id>/_part=2024-01-08   data folders, written before the commit and never changed after it

A writer first writes new folders through Spark, then the commit file
under another name, and renames it: readers see all tables of the old
version or all of the new one, whatever fails in between.  Folders that no
kept commit names (old versions, failed writes) go with ``vacuum``.  One writer
at a time: a second one that commits the same version is refused.

The commit files are read and written by the driver through Hadoop's file
system, so any store that Spark writes to will do; they hold one
line for each folder, never data.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PART = "_part"


@dataclass(frozen=True)
class Snapshot:
    """One committed version: the folders of each table by key, the tables' schemas and the load's notes."""

    version: int = 0
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    schemas: dict[str, dict] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    def keys(self, table: str) -> list[str]:
        return sorted(self.tables.get(table, {}))


class Snapshots:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    # ---- files ----------------------------------------------------------------------------------

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}".rstrip("/"))

    def _files(self):
        return self._path("_commits").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _list(self, name: str) -> list[str]:
        fs, path = self._files(), self._path(name)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._list("_commits") if n.endswith(".json") and n[:-5].isdigit()]

    def _load(self, version: int) -> Snapshot:
        stream = self._files().open(self._path(f"_commits/{version:012d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Snapshot(**json.loads(text))

    # ---- reading --------------------------------------------------------------------------------

    def head(self) -> Snapshot:
        """The newest commit; version 0, without tables, before the first."""
        versions = self._versions()
        return self._load(versions[-1]) if versions else Snapshot()

    def read(self, table: str, at: Snapshot | None = None, keys=None) -> DataFrame | None:
        """The table at a commit (the newest), or only some keys' folders; None before its first commit."""
        at = at or self.head()
        if table not in at.schemas:
            return None
        return self.folders(at, table, [f for k, f in sorted(at.tables[table].items()) if keys is None or k in keys])

    def folders(self, at: Snapshot, table: str, folders: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(at.schemas[table])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.base}/{f}" for f in folders])

    # ---- writing --------------------------------------------------------------------------------

    def write(self, df: DataFrame, table: str, key: str | None = None, by: str | None = None) -> tuple[dict[str, str], dict]:
        """New folders, not yet visible: one under ``key``, or one for each value of the column ``by``. Returns them with the schema."""
        folder = f"{table}/v{self.head().version + 1}-{uuid.uuid4().hex}"
        if by is None:
            df.write.parquet(f"{self.base}/{folder}")
            return {key or "all": folder}, df.schema.jsonValue()
        parted = df.withColumn(_PART, F.col(by).cast("string"))
        parted.hint("rebalance", _PART).write.partitionBy(_PART).parquet(f"{self.base}/{folder}")
        names = [n for n in self._list(folder) if n.startswith(f"{_PART}=")]
        return {n[len(_PART) + 1 :]: f"{folder}/{n}" for n in names}, df.schema.jsonValue()

    def commit(self, after: Snapshot, written: dict[str, tuple[dict[str, str], dict]], replace=(), drop: dict | None = None, notes: dict | None = None) -> Snapshot:
        """The version after ``after``: its folders, less ``drop`` (table -> keys), with the written ones put in.

        A written key replaces the folder it had; a table named in ``replace`` keeps nothing else.
        """
        tables = {t: dict(parts) for t, parts in after.tables.items()}
        for table, gone in (drop or {}).items():
            tables[table] = {k: f for k, f in tables.get(table, {}).items() if k not in set(gone)}
        for table, (parts, _) in written.items():
            tables[table] = parts if table in replace else {**tables.get(table, {}), **parts}
        schemas = {**after.schemas, **{t: schema for t, (_, schema) in written.items()}}
        made = Snapshot(after.version + 1, tables, schemas, {**after.notes, **(notes or {})})
        fs, last = self._files(), self._path(f"_commits/{made.version:012d}.json")
        draft = self._path(f"_commits/draft-{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(made.__dict__), "utf-8"))
        finally:
            stream.close()
        if fs.exists(last) or not fs.rename(draft, last):
            fs.delete(draft, False)
            raise RuntimeError(f"version {made.version} of {self.base} was committed by another writer")
        return made

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove all commits but the newest ``keep`` and the folders that none of these names; returns the folders removed."""
        fs, versions = self._files(), self._versions()
        kept = [self._load(v) for v in versions[-keep:]]
        if not kept:
            return []
        named = {f for s in kept for parts in s.tables.values() for f in parts.values()}
        newest, gone = kept[-1].version, []
        for table in [n for n in self._list("") if not n.startswith(("_", "."))]:
            for folder in self._list(table):
                made = int(folder[1:].split("-")[0])
                inner = [f"{table}/{folder}/{n}" for n in self._list(f"{table}/{folder}") if n.startswith(f"{_PART}=")]
                if made > newest:  # being written
                    continue
                mine = [f for f in (inner or [f"{table}/{folder}"]) if f not in named]
                whole = len(mine) == len(inner or [0])
                for f in [f"{table}/{folder}"] if whole else mine:
                    fs.delete(self._path(f), True)
                    gone.append(f)
        for v in versions[:-keep]:
            fs.delete(self._path(f"_commits/{v:012d}.json"), False)
        return gone
