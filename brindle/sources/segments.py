"""A table of Parquet segments with statistics, as a data source of Spark's own kind (``format("segments")``).

A write gives one segment a task; the driver then commits all of them by one manifest, which lists the
segments of the table with their rows and, by column, least and greatest values and nulls. Segments that
no manifest lists are not part of the table, so a failed task or job leaves no rows, and readers see one
manifest whole. A read makes one partition a segment and leaves those out that the pushed filters cannot
meet. Two jobs that commit at once do not overwrite each other: the second fails, as its manifest exists.

Paths are those of ``pyarrow.fs`` ("file:///...", "s3://...", or plain local ones). Filters are pushed only
where ``spark.sql.python.filterPushdown.enabled`` is set; Spark applies them again to what is read.
Columns without an order that JSON keeps (binary, nested) have no statistics. Nulls: a filter other than
IS NULL leaves out segments in which the column is null throughout.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType


def _plain(value):
    """A value of the statistics as JSON keeps it in order."""
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.replace(tzinfo=None).isoformat() if isinstance(value, datetime.datetime) else value.isoformat()
    return value


def _ordered(kind: pa.DataType) -> bool:
    return pa.types.is_integer(kind) or pa.types.is_floating(kind) or pa.types.is_string(kind) or pa.types.is_temporal(kind) or pa.types.is_boolean(kind)


class Store:
    """The files of a table."""

    def __init__(self, path: str):
        self.files, self.root = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))

    def versions(self) -> list[int]:
        found = self.files.get_file_info(fs.FileSelector(f"{self.root}/manifests", allow_not_found=True))
        return sorted(int(f.base_name.removesuffix(".json")) for f in found if f.base_name.endswith(".json") and f.base_name[0] != ".")

    def manifest(self) -> dict:
        known = self.versions()
        if not known:
            return {"version": -1, "schema": None, "segments": []}
        with self.files.open_input_stream(f"{self.root}/manifests/{known[-1]:012d}.json") as f:
            return json.loads(f.read())

    def commit(self, manifest: dict) -> None:
        self.files.create_dir(f"{self.root}/manifests")
        name = f"{self.root}/manifests/{manifest['version']:012d}.json"
        if self.files.get_file_info(name).type != fs.FileType.NotFound:
            raise RuntimeError(f"version {manifest['version']} has been committed by another job")
        hidden = f"{self.root}/manifests/.{uuid.uuid4().hex}.json"
        with self.files.open_output_stream(hidden) as f:
            f.write(json.dumps(manifest).encode())
        self.files.move(hidden, name)


@dataclass
class Segment(InputPartition):
    name: str


@dataclass
class Written(WriterCommitMessage):
    segment: dict | None


def may_meet(segment: dict, condition: Filter) -> bool:
    """Whether rows of a segment can meet a filter, by its statistics; filters that are not understood can."""
    stats = segment["columns"].get(condition.attribute[0]) if len(getattr(condition, "attribute", ())) == 1 else None
    if stats is None:
        return True
    low, high, nulls = stats
    if isinstance(condition, IsNull):
        return nulls > 0
    if isinstance(condition, IsNotNull):
        return nulls < segment["rows"]
    if not isinstance(condition, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
        return True
    if low is None:
        return nulls < segment["rows"]
    values = [_plain(v) for v in (condition.value if isinstance(condition, In) else [condition.value])]
    if isinstance(condition, (EqualTo, In)):
        return any(v is not None and low <= v <= high for v in values)
    (v,) = values
    return {GreaterThan: high > v, GreaterThanOrEqual: high >= v, LessThan: low < v, LessThanOrEqual: low <= v}[type(condition)]


class SegmentReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.columns, self.filters = path, schema.names, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        self.filters = [f for f in filters if len(getattr(f, "attribute", ())) == 1]
        return filters  # statistics leave out segments only, so Spark keeps all of them

    def partitions(self) -> list[Segment]:
        return [Segment(s["name"]) for s in Store(self.path).manifest()["segments"] if all(may_meet(s, f) for f in self.filters)] or [Segment("")]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        if partition.name:
            store = Store(self.path)
            with store.files.open_input_file(f"{store.root}/{partition.name}") as f:
                yield from pq.ParquetFile(f).iter_batches(columns=self.columns)


class SegmentWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema.json(), overwrite
        self.version = Store(path).manifest()["version"] + 1

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, name = Store(self.path), f"segments/{uuid.uuid4().hex}.parquet"
        store.files.create_dir(f"{store.root}/segments")
        rows, columns, writer, out = 0, {}, None, None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                out = store.files.open_output_stream(f"{store.root}/{name}")
                writer = pq.ParquetWriter(out, batch.schema, compression="zstd")
            writer.write_batch(batch)
            rows += batch.num_rows
            for field, column in zip(batch.schema, batch.columns, strict=True):
                if _ordered(field.type):
                    columns[field.name] = self._joined(columns.get(field.name), column)
        if writer is None:
            return Written(None)
        writer.close()
        out.close()
        return Written({"name": name, "rows": rows, "columns": {k: [_plain(v[0]), _plain(v[1]), v[2]] for k, v in columns.items()}})

    @staticmethod
    def _joined(known: tuple | None, column: pa.Array) -> tuple:
        ends = pc.min_max(column)
        low, high = ends["min"].as_py(), ends["max"].as_py()
        if known is None:
            return low, high, column.null_count
        some = lambda f, a, b: b if a is None else a if b is None else f(a, b)
        return some(min, known[0], low), some(max, known[1], high), known[2] + column.null_count

    def commit(self, messages: list[Written]) -> None:
        store = Store(self.path)
        before = [] if self.overwrite else store.manifest()["segments"]
        new = [m.segment for m in messages if m is not None and m.segment]
        store.commit({"version": self.version, "schema": self.schema, "segments": before + new})

    def abort(self, messages: list[Written]) -> None:
        store = Store(self.path)
        for m in messages:
            if m is not None and m.segment:
                store.files.delete_file(f"{store.root}/{m.segment['name']}")


class Segments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "segments"

    def schema(self) -> StructType:
        known = Store(self.options["path"]).manifest()["schema"]
        if known is None:
            raise ValueError(f"there is no table at {self.options['path']}")
        return StructType.fromJson(json.loads(known))

    def reader(self, schema: StructType) -> SegmentReader:
        return SegmentReader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> SegmentWriter:
        return SegmentWriter(self.options["path"], schema, overwrite)


def with_segments(spark: SparkSession) -> SparkSession:
    """``spark`` with the format registered and filters pushed to it."""
    spark.dataSource.register(Segments)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark
