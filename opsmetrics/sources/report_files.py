"""One stamped CSV file for each report and warehouse, as a data source with commit and abort.

    report_files.write_files(df, base, tag="report_picking", start=window.start)
    base/20240201003000WH10_report_picking_2024-01-01.csv

The name is that of the source: run time, ``WH`` and the warehouse's
number, tag, start date.  Each warehouse's rows go to one task, in the report's order, and
are streamed into a temporary file; a report holds one row for each
worker of a warehouse, so that is what one file and one task hold.  The files get their names in the commit;
if any task fails, the write is aborted and neither a file nor a
temporary folder stays.  A retried or speculative task writes a
temporary file of its own, of which the commit takes one.

The file system is found from the path (local or shared folder, or what
pyarrow knows: hdfs, s3, gs).  The source's class is built inside a
function, so it reaches the workers whole and the package need not be there.

Edge cases: an empty report writes no file; rows without a warehouse go to
``WHnone``; NULL is an empty field; intervals are written as their SQL text.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import printable

FORMAT = "report_files"
WAREHOUSE_PREFIX = "whracks"


def _source():
    from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

    class Written(WriterCommitMessage):
        def __init__(self, files):
            self.files = files  # name of the file -> temporary path

    class FilesWriter(DataSourceWriter):
        """Options: path, temporary (a folder under it that is this write's own); the first column is the file's name."""

        def __init__(self, options, columns):
            self.path, self.temporary, self.columns = options["path"].rstrip("/"), options["temporary"], columns

        def _files(self):
            import re

            from pyarrow import fs

            return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", self.path))

        def write(self, rows):
            import csv
            import io
            import uuid

            files, base = self._files()
            files.create_dir(f"{base}/{self.temporary}")
            done, name, out = {}, None, None
            try:
                for row in rows:  # sorted by the file's name
                    if out is None or row[0] != name:
                        if out is not None:
                            out.close()
                        name = row[0]
                        done[name] = f"{base}/{self.temporary}/{uuid.uuid4().hex}"
                        out = io.TextIOWrapper(files.open_output_stream(done[name]), encoding="utf-8", newline="")
                        sheet = csv.writer(out, lineterminator="\n")
                        sheet.writerow(self.columns[1:])
                    sheet.writerow(["" if v is None else v for v in tuple(row)[1:]])
            finally:
                if out is not None:
                    out.close()
            return Written(done)

        def commit(self, messages):
            files, base = self._files()
            made = [(name, at) for m in messages if m is not None for name, at in m.files.items()]
            if len({name for name, _ in made}) != len(made):
                raise RuntimeError("a file's rows came from more than one task")
            for name, at in made:
                files.move(at, f"{base}/{name}")
            self._clear(files, base)

        def abort(self, messages):
            self._clear(*self._files())

        def _clear(self, files, base):
            from pyarrow import fs

            if files.get_file_info(f"{base}/{self.temporary}").type != fs.FileType.NotFound:
                files.delete_dir(f"{base}/{self.temporary}")

    class Files(DataSource):
        @classmethod
        def name(cls):
            return "report_files"

        def writer(self, schema, overwrite):
            return FilesWriter(self.options, [f.name for f in schema.fields])

    return Files


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(_source())


def write_files(
    df: DataFrame,
    base: str,
    tag: str,
    start: dt.datetime,
    run: dt.datetime | None = None,
    order: tuple[str, ...] = ("emailaddress",),
) -> str:
    """Write the report's files into ``base``; returns the pattern of their names."""
    run = run or dt.datetime.now()
    register(df.sparkSession)
    left, right = f"{run:%Y%m%d%H%M%S}WH", f"_{tag}_{start:%Y-%m-%d}.csv"
    number = F.regexp_replace(F.regexp_replace("warehouse", f"^{WAREHOUSE_PREFIX}", ""), r"[^\w.-]", "_")
    name = F.concat(F.lit(left), F.coalesce(number, F.lit("none")), F.lit(right))
    rows = printable(df)
    rows = rows.select(name.alias("_file"), *rows.columns).repartition("_file")
    keys = [F.col(c).asc_nulls_last() for c in ("_file", *(c for c in order if c in df.columns))]
    out = rows.sortWithinPartitions(*keys).write.format(FORMAT).mode("append")
    out.option("path", base).option("temporary", f"_temporary-{uuid.uuid4().hex}").save()
    return f"{left}*{right}"
