"""Files, tables and commits: rolling output, staged commits with fences, upserts."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deltaloom.functions.scalars import est_row_size
from deltaloom.operators.merging import is_insert_only, merge_into


def file_key(path: str, pattern: str, ts: Column, version: int, counter: Column) -> Column:
    """``path/<date pattern>/v0000000000/00000000000000000000`` (K2); %Y %m %d %H %M %S %Z %z."""
    names = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%z": "xx"}
    parts, text, i = [], "", 0
    while i < len(pattern):
        code = pattern[i : i + 2]
        if code in names or code == "%Z":
            parts += [F.lit(text)] if text else []
            parts.append(F.lit("UTC") if code == "%Z" else F.date_format(ts, names[code]))
            text, i = "", i + 2
        else:
            text, i = text + pattern[i], i + 1
    parts += [F.lit(text)] if text else []
    return F.concat(F.lit(path.rstrip("/") + "/"), *parts, F.lit(f"/v{version:010d}/"), F.lpad(counter.cast("string"), 20, "0"))


#: A task writes about so many rolling files, or so many bytes of larger ones.
TASK_FILES, TASK_BYTES = 64, 256 << 20


def write_rolling_files(df: DataFrame, path: str, fmt: str, size_limit: int, **options: str) -> None:
    """Files of about ``size_limit`` bytes (K1): records a file from the mean estimated row size.

    Where that makes more files than the frame's partitions should write, rows are dealt over more tasks by
    ranges of their order.
    """
    n, mean = df.agg(F.count(F.lit(1)), F.avg(est_row_size(df))).first()
    each = max(1, int(size_limit / (mean or 1.0)))
    tasks = -(-n // (each * max(1, min(TASK_FILES, TASK_BYTES // size_limit))))
    if tasks > df.rdd.getNumPartitions():
        at = max(df.columns, key=len) + "_"
        df = df.withColumn(at, F.monotonically_increasing_id()).repartitionByRange(tasks, at).sortWithinPartitions(at).drop(at)
    df.write.options(**options).option("maxRecordsPerFile", each).mode("append").format(fmt).save(path)


def write_parquet(df: DataFrame, path: str, row_group: int = 128 << 20, compression: str = "snappy", dictionary: bool = True) -> None:
    """Parquet with a row group size in bytes, a codec and dictionaries or not (K3); files are added."""
    df.write.options(compression=compression, **{"parquet.block.size": str(row_group), "parquet.enable.dictionary": str(dictionary).lower()}).mode("append").parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """Quotes only where needed, doubled inside (K4)."""
    df.write.options(header=str(header).lower(), quote='"', escape='"', emptyValue='""', nullValue="").mode("append").csv(path)


def write_json(df: DataFrame, path: str, skip_nulls: bool = False, gzip: bool = True) -> None:
    """JSON lines, gzip by default; null fields are written unless they are skipped (K5)."""
    df.write.options(compression="gzip" if gzip else "none", ignoreNullFields=str(skip_nulls).lower()).mode("append").json(path)


class VersionedTable:
    """A Parquet table of version folders, published by one commit row each (K6-K9).

    ``path/v=N`` holds the data, ``path/_commits`` one small Parquet row per version: batch id,
    version, fence, checksum and the versions that make up the table. Data is written first and
    the commit row last, so a crash between them leaves an unreferenced folder, and a batch id
    that was committed is not applied again. A writer whose fence is below the newest
    one fails. All paths go through Spark's file systems.
    """

    COMMIT = "batch string, version long, fence long, live array<long>, note string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.COMMIT).parquet(f"{self.path}/_commits")
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], self.COMMIT)
            raise

    def _last(self):
        return self.commits().orderBy(F.desc("version")).limit(1).first()

    def install_fence(self) -> int:
        """A new session's fence: every older writer fails from now on (K9)."""
        last = self._last()
        fence = (last.fence if last else 0) + 1
        self._commit(f"fence-{fence}", fence, list(last.live) if last else [], "fence")
        return fence

    def _commit(self, batch: str, fence: int, live: list[int], note: str) -> int:
        last = self._last()
        if last and fence < last.fence:
            raise RuntimeError(f"fence {fence} is behind {last.fence}")
        version = (last.version if last else 0) + 1
        self.spark.createDataFrame([(batch, version, fence, live, note)], self.COMMIT).coalesce(1).write.mode("append").parquet(f"{self.path}/_commits")
        return version

    def committed(self, batch: str) -> bool:
        return not self.commits().where(F.col("batch") == batch).limit(1).isEmpty()

    def read(self, schema=None) -> DataFrame | None:
        last = self._last()
        if not last or not last.live:
            return None
        reader = self.spark.read.option("mergeSchema", "true")
        return (reader.schema(schema) if schema is not None else reader).parquet(*[f"{self.path}/v={v}" for v in last.live])

    def _write(self, df: DataFrame, batch: str) -> int:
        last = self._last()
        number = (last.version if last else 0) + 1
        df.write.mode("overwrite").parquet(f"{self.path}/v={number}")
        return number

    def append(self, df: DataFrame, batch: str, fence: int = 0) -> bool:
        """Add rows; a batch that is committed already is skipped (K6, K7)."""
        if self.committed(batch):
            return False
        last = self._last()
        number = self._write(df, batch)
        self._commit(batch, max(fence, 0), [*(last.live if last else []), number], "append")
        return True

    def merge(self, batch_df: DataFrame, batch: str, keys: list[str], deleted: Column | None = None, fence: int = 0) -> bool:
        """Merge one row a key, as an append where no key exists."""
        if self.committed(batch):
            return False
        target = self.read()
        columns = [c for c in batch_df.columns] if target is None else target.columns
        live = batch_df if deleted is None else batch_df.where(~F.coalesce(deleted, F.lit(False)))
        if target is None or is_insert_only(target, batch_df, keys):
            return self.append(live.select(*columns), batch, fence)
        number = self._write(merge_into(target, batch_df, keys, deleted), batch)
        self._commit(batch, fence, [number], "merge")
        return True

    def rewrite(self, change: Callable[[DataFrame], DataFrame], batch: str, fence: int = 0) -> bool:
        """A migration or compaction as a new version; staged work must be committed before (K8)."""
        target = self.read()
        if target is None or self.committed(batch):
            return False
        number = self._write(change(target), batch)
        self._commit(batch, fence, [number], "rewrite")
        return True


def batch_writer(table: VersionedTable, query: str, keys: list[str], reduce: Callable[[DataFrame], DataFrame] | None = None, deleted: Column | None = None, fence: int = 0) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: reduce, merge, commit once per batch id."""

    def write(df: DataFrame, batch_id: int) -> None:
        table.merge(reduce(df) if reduce else df, f"{query}-{batch_id}", keys, deleted, fence)

    return write


def drain_pending(table: VersionedTable, staged: Iterable[tuple[str, DataFrame]], keys: list[str]) -> int:
    """Commit staged batches, oldest first, before a table's schema changes (K8)."""
    return sum(table.merge(df, batch, keys) for batch, df in staged)


def at_least_once_send(df: DataFrame, send: Callable[[list[dict]], None], batch: int = 100, key: list[str] | None = None) -> None:
    """Rows in batches to a sender that runs on the executors, in key order where a key is given.

    A failed task sends again; documents are deltas and consumers take them at least once.
    """
    rows = df.repartition(*key).sortWithinPartitions(*key) if key else df
    columns = rows.columns

    def partition(it) -> None:
        held = []
        for row in it:
            held.append({c: row[c] for c in columns})
            if len(held) == batch:
                send(held)
                held = []
        if held:
            send(held)

    rows.foreachPartition(partition)


def bulk_upsert(df: DataFrame, keys: list[str], store: Callable[[list[tuple[str, str]]], None], batch: int = 100) -> None:
    """(id, document) pairs to a key-value store, each key by one task."""
    ids = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    docs = df.select(ids.alias("id"), F.to_json(F.struct(*df.columns)).alias("document")).repartition("id")

    def partition(it) -> None:
        held = []
        for row in it:
            held.append((row.id, row.document))
            if len(held) == batch:
                store(held)
                held = []
        if held:
            store(held)

    docs.foreachPartition(partition)


def merge_statement(table: str, staging: str, columns: list[str], keys: list[str], deleted: str | None = None) -> str:
    """SQL MERGE from a staging table (K12): names in double quotes, null keys match; with keys only, a match changes nothing.

    ``table`` and ``staging`` may have a schema before a dot.
    """
    quote = lambda name: '"' + name.replace('"', '""') + '"'
    whole = lambda name: ".".join(map(quote, name.split(".")))
    on = " AND ".join(f"t.{quote(k)} IS NOT DISTINCT FROM s.{quote(k)}" for k in keys)
    sets = ", ".join(f"{quote(c)} = s.{quote(c)}" for c in columns if c not in keys)
    gone = f" WHEN MATCHED AND s.{quote(deleted)} THEN DELETE" if deleted else ""
    changed = f" WHEN MATCHED THEN UPDATE SET {sets}" if sets else ""
    new = f" AND s.{quote(deleted)} IS NOT TRUE" if deleted else ""
    names, values = ", ".join(map(quote, columns)), ", ".join(f"s.{quote(c)}" for c in columns)
    return f"MERGE INTO {whole(table)} t USING {whole(staging)} s ON {on}{gone}{changed} WHEN NOT MATCHED{new} THEN INSERT ({names}) VALUES ({values})"


def jdbc_upsert(df: DataFrame, url: str, table: str, keys: list[str], execute: Callable[[str], None], properties: dict[str, str] | None = None) -> None:
    """Rows to a staging table over JDBC, then one MERGE that ``execute`` runs on the target."""
    staging = f"{table}_staging"
    df.write.mode("overwrite").jdbc(url, staging, properties=properties or {})
    execute(merge_statement(table, staging, df.columns, keys))


def clone_then_stream(clone: DataFrame, batches: DataFrame, seq: str, offset: str) -> DataFrame:
    """The clone as sequence 0, then staged batches by sequence and offset."""
    first = clone.withColumn(seq, F.lit(0).cast("long")).withColumn(offset, F.monotonically_increasing_id())
    return first.unionByName(batches, allowMissingColumns=True)


def state_json(states: dict[str, dict]) -> str:
    """Checkpoint of bindings as one JSON text, keys sorted."""
    return json.dumps(states, sort_keys=True, separators=(",", ":"))
