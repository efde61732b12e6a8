"""Written profile records as a data source of their own: `spark.read.format("profile_records").load(path)`.

Rows are the decoded samples, with the date, service, source and batch that the records were written
under. Filters on these four choose files before any is opened, every file is one partition, and
bodies are decoded where the file is read. Files are opened with Arrow, so the path must be one that
Arrow can open on the driver and the executors; for any other storage, `profile_log.read` and
`profile_log.decode` give the same rows through Spark's own reader.
"""

from __future__ import annotations

import operator
import urllib.parse
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import date

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from stackweave import session
from stackweave.sources import profile_log

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
FOLDERS = {"date": date.fromisoformat, "service": str, "source": str, "batch": int}
_SAMPLE = (
    "tick_ts timestamp, part int, format string, sample int, time_ms bigint, period_ms bigint, tid bigint, trace_id string, "
    "span_id string, frames array<struct<file:string,func:string,line:bigint>>, error string"
)
SCHEMA = f"date date, service string, source string, batch int, instance string, {_SAMPLE}"
_COMPARED = {
    EqualTo: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le,
}


@dataclass
class RecordFile(InputPartition):
    path: str
    values: dict

    def __post_init__(self) -> None:
        super().__init__(self.path)


class RecordReader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.tests = path, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Filters on folders are settled here; Spark keeps the others."""
        for one in filters:
            name = one.attribute[0] if len(getattr(one, "attribute", ())) == 1 else None
            if name in FOLDERS and type(one) in _COMPARED:
                self.tests.append((name, _COMPARED[type(one)], one.value))
            elif name in FOLDERS and isinstance(one, In):
                self.tests.append((name, lambda value, among: value in among, tuple(one.value)))
            else:
                yield one

    def partitions(self) -> list[RecordFile]:
        system, root = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)
        found = []
        for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            parts = dict(part.split("=", 1) for part in info.path.split("/") if "=" in part)
            if info.is_file and info.path.endswith(".parquet") and set(FOLDERS) <= set(parts):
                values = {name: read(urllib.parse.unquote(parts[name])) for name, read in FOLDERS.items()}
                if all(test(values[name], wanted) for name, test, wanted in self.tests):
                    found.append(RecordFile(info.path, values))
        return found

    def read(self, partition: RecordFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark's stand-in where there is no file to read
            return
        system = fs.FileSystem.from_uri(self.path)[0] if "://" in self.path or self.path.startswith("file:") else fs.LocalFileSystem()
        with system.open_input_file(partition.path) as file:
            for batch in pq.ParquetFile(file).iter_batches(batch_size=16):
                for decoded in profile_log.decode_batches([self._named(batch, partition.values)]):
                    yield self._shaped(decoded, partition.values)

    @staticmethod
    def _named(batch: pa.RecordBatch, values: dict) -> pa.RecordBatch:
        """The columns that the codec reads; what a record is called lies in its folder."""
        attributes = [dict(row or ()) for row in batch.column("attributes").to_pylist()]
        same = {name: pa.array([values[name]] * batch.num_rows) for name in ("service", "source")}
        formats = pa.array([row.get(profile_log.FORMAT_ATTRIBUTE) for row in attributes], pa.string())
        columns = [same["service"], batch.column("instance"), same["source"], batch.column("tick_ts"), batch.column("part"), formats, batch.column("body")]
        return pa.RecordBatch.from_arrays(columns, [*profile_log.profiles.KEY, "format", "body"])

    @staticmethod
    def _shaped(decoded: pa.RecordBatch, values: dict) -> pa.RecordBatch:
        count = decoded.num_rows
        columns = {
            "date": pa.array([values["date"]] * count, pa.date32()), "batch": pa.array([values["batch"]] * count, pa.int32()),
            "tick_ts": decoded.column("tick_ts").cast(pa.timestamp("us")).cast(pa.timestamp("us", "UTC")),
        }
        names = [part.split()[0] for part in SCHEMA.replace("array<struct<file:string,func:string,line:bigint>>", "frames").split(", ")]
        return pa.RecordBatch.from_arrays([columns[n] if n in columns else decoded.column(n) for n in names], names)


class ProfileRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return "profile_records"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RecordReader:
        return RecordReader(self.options["path"])


def register(spark: SparkSession) -> SparkSession:
    """Make the format known to a session, with filters handed to it."""
    session.prepare(spark)
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(ProfileRecords)
    return spark
