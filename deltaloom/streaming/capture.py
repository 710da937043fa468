"""Captures as streaming sources: cursors and file sweeps whose state is the stream's offset."""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv
import pyarrow.dataset as ds
import pyarrow.fs
import pyarrow.json
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType


@dataclass(frozen=True)
class Cursor:
    """A closing cursor: all rows of a capture up to it have been given."""

    value: Any


class Client:
    """What a cursor capture asks of a system. Clients travel to the executors; cursors are numbers or text that sorts."""

    def subtasks(self) -> list[str]:
        """Parts of the capture with a cursor each."""
        return [""]

    def start(self, subtask: str) -> Any:
        """The cursor before a subtask's first row."""
        raise NotImplementedError

    def latest(self, subtask: str) -> Any:
        """The greatest cursor up to which a subtask can be read now, None for no row."""
        raise NotImplementedError

    def plan(self, subtask: str, after: Any, upto: Any) -> list[Any]:
        """Shares of a subtask's rows that are fetched by a task each."""
        return [None]

    def fetch(self, subtask: str, after: Any, upto: Any, share: Any) -> Iterator[pa.RecordBatch | Cursor]:
        """Rows with after < cursor <= upto, and cursors that rise; the last item is ``Cursor(upto)``."""
        raise NotImplementedError


@dataclass
class _Share(InputPartition):
    subtask: str
    after: Any
    upto: Any
    share: Any


class CursorReader(DataSourceStreamReader):
    """Offsets are the cursors of the subtasks, so a batch is the rows between two of them and a restart goes on from the last."""

    def __init__(self, client: Client, schema: pa.Schema):
        self.client, self.schema = client, schema

    def initialOffset(self) -> dict:
        return {s: self.client.start(s) for s in self.client.subtasks()}

    def latestOffset(self) -> dict:
        found = {s: self.client.latest(s) for s in self.client.subtasks()}
        return {s: self.client.start(s) if v is None else v for s, v in found.items()}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        out = []
        for subtask, upto in end.items():
            # A subtask that has come since the last batch begins at its start.
            after = start[subtask] if subtask in start else self.client.start(subtask)
            if upto == after:
                continue
            if not after < upto:
                raise RuntimeError(f"cursor of {subtask or 'the capture'} fell from {after!r} to {upto!r}")
            out += [_Share(subtask, after, upto, share) for share in self.client.plan(subtask, after, upto)]
        return out

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        p: Any = partition
        last, open_rows = p.after, False
        for item in self.client.fetch(p.subtask, p.after, p.upto, p.share):
            if not isinstance(item, Cursor):
                open_rows = open_rows or item.num_rows > 0
                yield pa.RecordBatch.from_arrays([item.column(f.name).cast(f.type) for f in self.schema], schema=self.schema)
                continue
            if type(item.value) is not type(last) or not item.value > last:
                raise RuntimeError(f"cursor {item.value!r} is not above {last!r}")
            last, open_rows = item.value, False
        if open_rows or last != p.upto:
            raise RuntimeError(f"rows of {p.subtask or 'the capture'} after {last!r} have no closing cursor")


def _stream(spark: SparkSession, name: str, schema: StructType, reader: DataSourceStreamReader) -> DataFrame:
    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> StructType:
            return schema

        def streamReader(self, schema: StructType) -> DataSourceStreamReader:
            return reader

    spark.dataSource.register(Source)
    return spark.readStream.format(name).load()


def read_cursor(spark: SparkSession, client: Client, schema: StructType, name: str = "cursor_capture") -> DataFrame:
    """A stream of the rows that a client captures, from its start or the query's checkpoint on.

    A cursor that falls, one that does not rise inside a batch, and rows without a closing
    cursor fail the query; nothing of the batch is then committed.
    """
    return _stream(spark, name, schema, CursorReader(client, to_arrow_schema(schema)))


def _files(root: str) -> tuple[pyarrow.fs.FileSystem, list[pyarrow.fs.FileInfo]]:
    fs, path = pyarrow.fs.FileSystem.from_uri(root)
    top = fs.get_file_info(path)
    found = [top] if top.is_file else fs.get_file_info(pyarrow.fs.FileSelector(path, recursive=True, allow_not_found=True))
    hidden = lambda f: any(part.startswith(("_", ".")) for part in f.path.removeprefix(path).split("/"))
    return fs, sorted((f for f in found if f.is_file and f.size and (top.is_file or not hidden(f))), key=lambda f: f.path)


class ParquetLog(Client):
    """An append-only log of Parquet files with a cursor column; a file is a task's share.

    Cursors are read from the files' statistics, up to ``horizon`` if there is one. Files are found by
    listing the folder, so a cursor may only appear once all rows at or below it are there.
    """

    def __init__(self, path: str, cursor: str, start: Any = -1, horizon: Any = None):
        self.path, self.cursor, self.first, self.horizon = path, cursor, start, horizon

    def start(self, subtask: str) -> Any:
        return self.first

    def _ranges(self) -> list[tuple[str, Any, Any]]:
        fs, files = _files(self.path)
        out = []
        for f in files:
            with fs.open_input_file(f.path) as source:
                meta = pq.ParquetFile(source).metadata
                at = next(i for i in range(meta.num_columns) if meta.schema.column(i).path == self.cursor)
                stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            if any(s is None or not s.has_min_max for s in stats if s is None or s.num_values):
                raise ValueError(f"{f.path} has no statistics of {self.cursor}")
            if any(s.null_count for s in stats):
                raise RuntimeError(f"{f.path} has rows without {self.cursor}")
            bounds = [(s.min, s.max) for s in stats if s.num_values]
            if bounds:
                out.append((f.path, min(b[0] for b in bounds), max(b[1] for b in bounds)))
        return out

    def latest(self, subtask: str) -> Any:
        ranges = self._ranges()
        if self.horizon is not None and any(high > self.horizon for _, _, high in ranges):
            return self.horizon if any(low <= self.horizon for _, low, _ in ranges) else None
        return max((high for _, _, high in ranges), default=None)

    def plan(self, subtask: str, after: Any, upto: Any) -> list[Any]:
        return [path for path, low, high in self._ranges() if low <= upto and high > after]

    def fetch(self, subtask: str, after: Any, upto: Any, share: Any) -> Iterator[pa.RecordBatch | Cursor]:
        fs, _ = pyarrow.fs.FileSystem.from_uri(self.path)
        field = pc.field(self.cursor)
        yield from ds.dataset(share, filesystem=fs, format="parquet").to_batches(filter=(field > after) & (field <= upto))
        yield Cursor(upto)


@dataclass
class _File(InputPartition):
    path: str


class SweepReader(DataSourceStreamReader):
    """Sweeps of a folder (S1, S2): the offset is the horizon of modification times swept, or with ``monotonic`` the last path.

    A sweep's horizon lies ``lag`` seconds before now, so files that stores list late are not missed; empty
    files are passed over. A file that is written again is swept again, as a whole. A horizon or path that falls,
    as with a longer lag or once the last file is gone, fails the query.
    """

    def __init__(self, root: str, fmt: str, schema: pa.Schema, monotonic: bool, lag: float):
        self.root, self.format, self.schema, self.monotonic, self.lag = root, fmt, schema, monotonic, lag

    def initialOffset(self) -> dict:
        return {"after": "" if self.monotonic else 0}

    def _place(self, f: pyarrow.fs.FileInfo) -> Any:
        return f.path if self.monotonic else f.mtime_ns // 1000

    def latestOffset(self) -> dict:
        horizon = int((time.time() - self.lag) * 1_000_000)
        if not self.monotonic:
            return {"after": horizon}
        return {"after": max((f.path for f in _files(self.root)[1] if f.mtime_ns // 1000 <= horizon), default="")}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if end["after"] < start["after"]:
            raise RuntimeError(f"sweep of {self.root} fell from {start['after']!r} to {end['after']!r}")
        return [_File(f.path) for f in _files(self.root)[1] if start["after"] < self._place(f) <= end["after"]]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        fs, _ = pyarrow.fs.FileSystem.from_uri(self.root)
        path, at = partition.path, 0  # type: ignore[attr-defined]
        data = pa.schema([f for f in self.schema if f.name not in ("file", "offset")])
        for batch in self._batches(fs, path, data):
            n = batch.num_rows
            columns = [batch.column(f.name).cast(f.type) if f.name in batch.schema.names else pa.nulls(n, f.type) for f in data]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([path] * n, pa.string()), pa.array(range(at, at + n), pa.int64())], schema=self.schema)
            at += n

    def _batches(self, fs: pyarrow.fs.FileSystem, path: str, data: pa.Schema) -> Iterator[pa.RecordBatch]:
        if self.format == "parquet":
            with fs.open_input_file(path) as source:
                file = pq.ParquetFile(source)
                yield from file.iter_batches(columns=[n for n in data.names if n in file.schema_arrow.names])
            return
        with fs.open_input_stream(path, compression="detect") as source:
            if self.format == "csv":
                yield from pyarrow.csv.open_csv(source, convert_options=pyarrow.csv.ConvertOptions(column_types=data))
            elif self.format == "json":
                yield from pyarrow.json.open_json(source, parse_options=pyarrow.json.ParseOptions(explicit_schema=data, unexpected_field_behavior="ignore"))
            else:
                raise ValueError(f"no sweep of {self.format}")


def read_sweep(spark: SparkSession, root: str, fmt: str, schema: StructType, monotonic: bool = False, lag: float = 0.0, name: str = "file_sweep") -> DataFrame:
    """A stream of the records of a folder's files, with ``file`` and ``offset`` (the record's number in it) as their key.

    ``fmt`` is parquet, csv (with a header) or json (lines); columns that a file lacks are null. Each file is one task.
    """
    whole = StructType([*schema.fields, StructField("file", StringType()), StructField("offset", LongType())])
    return _stream(spark, name, whole, SweepReader(root, fmt, to_arrow_schema(whole), monotonic, lag))


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Read what a stream has now and append it to Parquet files, once each."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
