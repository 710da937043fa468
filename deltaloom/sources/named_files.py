"""Files of a bounded size under names of their own: tasks stage them, a commit moves them into place."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime, timezone
from decimal import Decimal
from typing import Any

import pyarrow as pa
import pyarrow.csv
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Ends of file names by format.
ENDS = {"parquet": ".parquet", "csv": ".csv", "json": ".jsonl"}


def file_prefix(root: str, pattern: str, at: datetime, version: int) -> str:
    """``root/<date pattern>/v0000000000`` (K2); %Y %m %d %H %M %S %Z %z of the time in UTC."""
    at = at.astimezone(timezone.utc) if at.tzinfo else at.replace(tzinfo=timezone.utc)
    known = re.sub("%[YmdHMSZz]", lambda m: at.strftime(m.group()), pattern).strip("/")
    return "/".join([root.rstrip("/"), *([known] if known else []), f"v{version:010d}"])


@dataclass
class _Staged(WriterCommitMessage):
    """Paths of a task's files in order, and the rows in each."""

    part: int
    files: list[tuple[str, int]]


def _plain(value: Any) -> Any:
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    if isinstance(value, datetime):
        return (value.astimezone(timezone.utc) if value.tzinfo else value).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    if isinstance(value, (date, Decimal)):
        return str(value)
    return value.hex() if isinstance(value, bytes) else value


class _File:
    """One open file; ``size`` are the bytes that reached the store."""

    def __init__(self, fs: pyarrow.fs.FileSystem, path: str, fmt: str, schema: pa.Schema, options: dict[str, str]):
        self.path, self.rows, self.options, self.format = path, 0, options, fmt
        self.sink = fs.open_output_stream(path, compression=None)
        self.out: Any = pa.CompressedOutputStream(self.sink, "gzip") if options.get("gzip") == "true" else self.sink
        if fmt == "parquet":
            self.writer: Any = pq.ParquetWriter(self.out, schema, compression=options.get("compression", "snappy"))
        elif fmt == "csv":
            self.writer = pyarrow.csv.CSVWriter(self.out, schema, write_options=pyarrow.csv.WriteOptions(include_header=options.get("header", "true") == "true", quoting_style="needed"))
        else:
            self.writer = None

    def write(self, batch: pa.RecordBatch) -> None:
        self.rows += batch.num_rows
        if self.writer is not None:
            self.writer.write_batch(batch)
            return
        skip = self.options.get("skipNulls") == "true"
        rows = ({k: v for k, v in row.items() if v is not None} if skip else row for row in batch.to_pylist())
        self.out.write("".join(json.dumps(_plain(row), ensure_ascii=False, separators=(",", ":")) + "\n" for row in rows).encode())

    @property
    def size(self) -> int:
        return self.sink.tell()

    def close(self) -> None:
        if self.writer is not None:
            self.writer.close()
        self.out.close()
        if self.out is not self.sink:
            self.sink.close()


#: Rows between two looks at a file's size.
STEP = 1_000


class NamedFileWriter(DataSourceArrowWriter):
    """Tasks write below ``_staging``; the commit gives files the next numbers of their version, in the order of partitions.

    A task that fails deletes what it staged, an aborted job all of it, after which no task can begin to stage; so a folder
    of names has whole files of committed jobs only. One job at a time may write to a version.
    """

    def __init__(self, options: dict[str, str], schema: pa.Schema):
        self.options, self.schema = options, schema
        self.format, self.limit = options.get("fileformat", "parquet"), int(options.get("sizelimit", str(1 << 27)))
        if self.format not in ENDS:
            raise ValueError(f"no files of {self.format}")
        at = datetime.fromisoformat(options["time"]) if "time" in options else datetime.now(timezone.utc)
        _, root = pyarrow.fs.FileSystem.from_uri(options["path"])
        self.target = file_prefix(root, options.get("pattern", ""), at, int(options.get("version", "0")))
        self.staging = f"{root.rstrip('/')}/_staging/{uuid.uuid4().hex}"
        self._fs().create_dir(self.staging)

    def _fs(self) -> pyarrow.fs.FileSystem:
        return pyarrow.fs.FileSystem.from_uri(self.options["path"])[0]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, context = self._fs(), TaskContext.get()
        part, folder = context.partitionId(), f"{self.staging}/{context.partitionId()}-{context.taskAttemptId()}"
        done: list[tuple[str, int]] = []
        now: _File | None = None
        try:
            for batch in iterator:
                for at in range(0, batch.num_rows, STEP):
                    if now is None:
                        if not done:
                            fs.create_dir(folder, recursive=False)  # fails once the job was aborted
                        options = {"gzip": self.options.get("gzip", "true" if self.format == "json" else "false"), "skipNulls": self.options.get("skipnulls", "false"), **{k: v for k, v in self.options.items() if k in ("compression", "header")}}
                        now = _File(fs, f"{folder}/{len(done)}", self.format, self.schema, options)
                    now.write(batch.slice(at, STEP).cast(self.schema))
                    if now.size >= self.limit:
                        now.close()
                        done.append((now.path, now.rows))
                        now = None
            if now is not None:
                now.close()
                done.append((now.path, now.rows))
        except BaseException:
            if now is not None:
                now.sink.close()
            if fs.get_file_info(folder).type != pyarrow.fs.FileType.NotFound:
                fs.delete_dir(folder)
            raise
        return _Staged(part, done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs = self._fs()
        fs.create_dir(self.target)
        known = [int(m.group(1)) for f in fs.get_file_info(pyarrow.fs.FileSelector(self.target)) if (m := re.match(r"(\d{20})\.", f.base_name))]
        number = max(known, default=-1) + 1
        end = ENDS[self.format] + (".gz" if self.options.get("gzip", "true" if self.format == "json" else "false") == "true" else "")
        for message in sorted((m for m in messages if isinstance(m, _Staged)), key=lambda m: m.part):
            for path, _ in message.files:
                fs.move(path, f"{self.target}/{number:020d}{end}")
                number += 1
        self._clear(fs)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear(self._fs())

    def _clear(self, fs: pyarrow.fs.FileSystem) -> None:
        if fs.get_file_info(self.staging).type != pyarrow.fs.FileType.NotFound:
            fs.delete_dir(self.staging)
        above = self.staging.rpartition("/")[0]
        if fs.get_file_info(above).type != pyarrow.fs.FileType.NotFound and not fs.get_file_info(pyarrow.fs.FileSelector(above)):
            fs.delete_dir(above)


class NamedFiles(DataSource):
    """The data source ``named_files`` for writing. Options: path, fileFormat, sizeLimit, pattern, version, time, gzip, skipNulls, header, compression."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "file string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("named files are only added to")
        return NamedFileWriter({k.lower(): v for k, v in self.options.items()}, to_arrow_schema(schema))


def write_named_files(df: DataFrame, path: str, fmt: str = "parquet", size_limit: int = 1 << 27, pattern: str = "", version: int = 0, time: str | None = None, **options: str) -> None:
    """Files ``path/<pattern>/v<version>/<number><end>`` of about ``size_limit`` bytes each, as written (K1, K2, K5).

    A file ends with the STEP rows that reach the limit (with gzip, as far as compressed bytes were
    put out; a Parquet file's footer comes on top). Numbers go on from the greatest of the version. An empty frame gives no files.
    """
    df.sparkSession.dataSource.register(NamedFiles)
    writer = df.write.format("named_files").mode("append").options(path=path, fileFormat=fmt, sizeLimit=str(size_limit), pattern=pattern, version=str(version), **options)
    (writer.option("time", time) if time else writer).save()
