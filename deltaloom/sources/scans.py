"""Scans, polls and file sweeps."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime
from decimal import Decimal
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deltaloom.session import settled

FORMATS = ("parquet", "orc", "csv", "tsv", "json", "jsonl", "ndjson", "avro", "txt")


@dataclass(frozen=True)
class SweepState:
    """Modification window of a sweep and, inside it, the last path read."""

    min_bound: str | None = None
    max_bound: str | None = None
    path: str | None = None


def resolve_format(path: Column) -> Column:
    """Format by extension segments, last known one first: ``x.parquet.gz`` is parquet (S3)."""
    parts = F.reverse(F.split(F.lower(F.element_at(F.split(path, "/"), -1)), r"\."))
    known = F.get(F.filter(parts, lambda p: p.isin(*FORMATS)), 0)
    return F.when(known.isin("jsonl", "ndjson"), "json").when(known == "tsv", "csv").otherwise(known)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, modified, size, format) of every file below a root; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"), resolve_format(F.col("path")).alias("format"))


def sweep_listing(listing: DataFrame, state: SweepState, path_regex: str = "") -> DataFrame:
    """Files a sweep takes: not empty, matching, inside the window, after the last path."""
    kept = listing.where((F.col("size") > 0) & F.col("path").rlike(path_regex))
    if state.min_bound:
        kept = kept.where(F.col("modified") > F.lit(state.min_bound).cast("timestamp"))
    if state.max_bound:
        kept = kept.where(F.col("modified") < F.lit(state.max_bound).cast("timestamp"))
    return kept.where(F.col("path") > state.path) if state.path else kept


def sweep_files(spark: SparkSession, paths: list[str], fmt: str, **options: str) -> DataFrame:
    """Records of files of one format with ``_meta`` (file, offset) as their key.

    Offsets number a file's records from 0; Parquet has row positions, text is ordered by block and row.
    """
    df = spark.read.format(fmt).options(**options).load(paths)
    if fmt == "parquet":
        rows = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_offset"))
    else:
        raw = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_n"))
        rows = raw.withColumn("_offset", F.row_number().over(Window.partitionBy("_file").orderBy("_block", "_n")).cast("long") - 1).drop("_block", "_n")
    return rows.withColumn("_meta", F.struct(F.col("_file").alias("file"), F.col("_offset").alias("offset"))).drop("_file", "_offset")


def next_sweep_bounds(state: SweepState, swept: DataFrame, monotonic: bool) -> SweepState:
    """The state after a sweep (S2): one row of aggregates comes to the driver."""
    row = swept.agg(F.max("modified").cast("string").alias("m"), F.max("path").alias("p")).first()
    if row.m is None:
        return state
    return SweepState(state.min_bound, None, row.p) if monotonic else SweepState(row.m, None, None)


def read_csv_nulls(spark: SparkSession, path: str, schema: str, null_value: str = "", strict_width: bool = True, null_values: set[str] | None = None, **options: str) -> DataFrame:
    """CSV with one null token or several; with ``strict_width`` rows of another width fail the read.

    With ``null_values`` every column is read as text, tokens become null and the rest is cast; text that its type can't hold fails.
    An empty field is null only if the empty text is a token.
    """
    kinds = spark.createDataFrame([], schema).schema
    texts = ", ".join(f"`{f.name}` string" for f in kinds) if null_values is not None else schema
    reader = spark.read.schema(texts).option("header", "true").option("nullValue", null_value).option("enforceSchema", "false").options(**options)
    rows = reader.option("mode", "FAILFAST" if strict_width else "PERMISSIVE").csv(path)
    if null_values is None:
        return rows
    plain = lambda name: F.coalesce(F.col(f"`{name}`"), F.lit(null_value))
    return rows.select(*[F.when(~plain(f.name).isin(*null_values), plain(f.name)).cast(f.dataType).alias(f.name) for f in kinds])


def read_json_items(spark: SparkSession, path: str, item_path: str, schema: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Items under a path of JSON documents and the rest of each document (S5); a document is one task's."""
    reader = spark.read.option("multiLine", "true")
    docs = (reader.schema(schema) if schema else reader).json(path)
    top, *inner = item_path.split(".")
    rest = docs.drop(top) if not inner else docs.withColumn(top, F.col(top).dropFields(".".join(inner)))
    return docs.select(F.explode(F.col(item_path)).alias("item")).select("item.*"), rest


def after(columns: list[str], values: list) -> Column:
    """``(a, b) > (x, y)`` as ``a > x OR (a = x AND b > y)``, the form that reaches the Parquet scan."""
    out = None
    for i in reversed(range(len(columns))):
        c, v = F.col(columns[i]), F.lit(values[i])
        out = c > v if out is None else (c > v) | ((c == v) & out)
    return out


def scan_keyset_chunk(df: DataFrame, keys: list[str], last: list | None, limit: int) -> DataFrame:
    """The next rows in key order (S6); text keys compare byte-wise."""
    rows = df.where(after(keys, last)) if last else df
    return rows.orderBy(*keys).limit(limit)


def scan_ranges(df: DataFrame, column: str, bounds: list[tuple]) -> DataFrame:
    """Rows of half-open ranges (lo, hi] with the range's number."""
    number = reduce(lambda acc, b: acc.when((F.col(column) > b[1][0]) & (F.col(column) <= b[1][1]), b[0]), list(enumerate(bounds))[1:], F.when((F.col(column) > bounds[0][0]) & (F.col(column) <= bounds[0][1]), 0))
    return df.withColumn("range_no", number).where("range_no IS NOT NULL")


def scan_segments(df: DataFrame, key: str, n: int, done: list[int] | None = None) -> DataFrame:
    """Segments of a table by key hash; finished ones are left out."""
    rows = df.withColumn("segment", F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))
    return rows.where(~F.col("segment").isin(done)) if done else rows


def poll_cursor(df: DataFrame, cursor: list[str], last: list | None) -> DataFrame:
    """Rows after the cursor, or all of them without one."""
    return df.where(after(cursor, last)) if cursor and last else df


def next_cursor(df: DataFrame, cursor: list[str]):
    """The greatest cursor of a poll, None for no rows."""
    return df.agg(F.max(F.struct(*cursor)).alias("c")).first().c


def poll_xid_window(df: DataFrame, xid: str, base: int, upto: int) -> DataFrame:
    """Rows whose 32-bit wrapping transaction id is in [base, upto]; frozen ids (< 3) are left out."""
    ahead = lambda x: F.shiftright(F.shiftleft(x, 32), 32) >= 0
    c = F.col(xid).cast("long")
    return df.where((c >= 3) & ahead(c - F.lit(base)) & ahead(F.lit(upto) - c))


#: Ranks of types in mixed-type key order (fixed values).
TYPE_RANKS = {"null": 1, "number": 2, "string": 3, "object": 4, "array": 5, "binary": 6, "boolean": 8, "timestamp": 9}


def resume_type_bracketed(df: DataFrame, rank: str, number: str, text: str, last_rank: int, last) -> DataFrame:
    """Rest of the last key's type and every type that sorts after it."""
    same = F.col(number) > F.lit(last) if last_rank == TYPE_RANKS["number"] else F.col(text) > F.lit(last)
    return df.where((F.col(rank) > last_rank) | ((F.col(rank) == last_rank) & same))


def type_rank(cursor: Column) -> Column:
    """Rank of a variant's type in mixed-type key order; null for arrays, which have no place in it."""
    kind = F.schema_of_variant(cursor)
    number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    named = {"null": kind == "VOID", "number": number, "string": kind == "STRING", "object": kind.startswith("OBJECT"), "binary": kind == "BINARY", "boolean": kind == "BOOLEAN", "timestamp": kind.isin("TIMESTAMP", "TIMESTAMP_NTZ", "DATE")}
    out = F.when(cursor.isNull(), TYPE_RANKS["null"])
    for name, test in named.items():
        out = out.when(test, TYPE_RANKS[name])
    return out


def resume_after(df: DataFrame, cursor: str, last) -> DataFrame:
    """Rows whose variant cursor sorts after ``last``, a value of any type but an object or an array.

    The rest of the value's own type, and every type that sorts after it: null, numbers, text, objects, binary, booleans (false
    first), times. Numbers compare by value whatever their width; text and binary compare byte-wise, dates as midnight in UTC.
    """
    c = F.col(cursor)
    if last is None:
        own, rank = F.lit(False), "null"
    elif isinstance(last, bool):
        own, rank = F.try_variant_get(c, "$", "boolean") > F.lit(last), "boolean"
    elif isinstance(last, (int, float, Decimal)):
        wide = F.try_variant_get(c, "$", "decimal(38,9)")
        exact = wide > F.lit(str(last)).try_cast("decimal(38,9)")
        own, rank = F.coalesce(exact, F.try_variant_get(c, "$", "double") > F.lit(float(last))), "number"
    elif isinstance(last, str):
        own, rank = F.try_variant_get(c, "$", "string") > F.lit(last), "string"
    elif isinstance(last, bytes):
        own, rank = F.try_variant_get(c, "$", "binary") > F.lit(last), "binary"
    elif isinstance(last, datetime):
        own, rank = F.try_variant_get(c, "$", "timestamp") > F.lit(last), "timestamp"
    else:
        raise TypeError(f"no scan resumes at {last!r}")
    at = type_rank(c)
    return df.where((at > TYPE_RANKS[rank]) | ((at == TYPE_RANKS[rank]) & own))


def plan_restated_tables(tables: DataFrame, day: str, state: str, window_days: int, intermediate: bool) -> DataFrame:
    """Reads of dated tables, newest first (S12): once on arrival, inside the window on each poll if wanted, finally at its oldest day.

    With fewer tables than ``window_days`` none is final.
    """
    rank = F.row_number().over(Window.orderBy(F.desc(day)))
    ranked = tables.withColumn("_rank", rank)
    action = F.when(F.col(state) == "final", None).when(F.col("_rank") >= window_days, "final").when(F.col(state).isNull(), "arrival").when(F.lit(intermediate), "intermediate")
    return ranked.withColumn("action", action).where("action IS NOT NULL").orderBy(F.desc(day)).drop("_rank")


def read_restated_table(df: DataFrame, day: str, defaults: dict[str, object], cursor: list[str]) -> DataFrame:
    """A day's rows with schema defaults for null key columns and the table date in ``_meta``."""
    rows = df.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in defaults.items()})
    return rows.withColumn("_meta", F.struct(F.lit(day).alias("table_date"))).orderBy(*cursor)


def glob_regexes(glob: str) -> list[str]:
    """Patterns of a table glob (S14): [table], or [schema, table] where a dot without a backslash parts them.

    ``*`` is any run of characters and ``?`` any one, of one name; a backslash takes the next character as it is.
    """
    parts, at = [""], iter(glob)
    for c in at:
        if c == "\\":
            if (literal := next(at, None)) is None:
                raise ValueError(f"{glob!r} ends with a backslash")
            parts[-1] += re.escape(literal)
        elif c == ".":
            parts.append("")
        else:
            parts[-1] += {"*": ".*", "?": "."}.get(c, re.escape(c))
    if len(parts) > 2 or not all(parts):
        raise ValueError(f"{glob!r} must be a table or a schema and a table")
    return [f"(?s)^{p}\\z" for p in parts]


def select_tables(names: DataFrame, globs: list[str], schema: str = "schema", table: str = "table") -> DataFrame:
    """Tables that some glob takes; one without a schema takes its tables in every schema."""
    def matches(patterns: list[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).rlike(p) for c, p in zip([schema, table][-len(patterns) :], patterns, strict=True)])

    return names.where(reduce(lambda a, b: a | b, [matches(glob_regexes(g)) for g in globs], F.lit(False)))


def plan_windows(events: DataFrame, ts: str, max_rows: int, bucket: str = "hour") -> DataFrame:
    """Windows of at most ``max_rows`` rows: each takes buckets in order as long as they fit.

    A bucket with more rows than the limit is a window of its own. Buckets are dealt by ranges of time, and
    each range cuts its windows given the rows held before it. All ranges start with none held; a range whose predecessor ends
    with another number cuts again, until none does. Cuts fall together after a few
    windows as a rule, so few ranges are cut twice. A row for each range comes to the driver.
    """
    counts = events.groupBy(F.date_trunc(bucket, ts).alias("start")).agg(F.count(F.lit(1)).alias("n"))
    parts = settled(counts.repartitionByRange("start").sortWithinPartitions("start"))
    kind = counts.schema["start"].dataType.simpleString()

    def cuts(held: dict[int, int]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = TaskContext.get().partitionId()
            now, number = held.get(part, 0), 0
            for batch in batches:
                numbers = []
                for n in batch.column("n").to_pylist():
                    if now and now + n > max_rows:
                        now, number = 0, number + 1
                    now += n
                    numbers.append(number)
                yield pa.RecordBatch.from_arrays([batch.column("start"), batch.column("n"), pa.array([part] * len(numbers), pa.int32()), pa.array(numbers, pa.int64()), pa.array([now] * len(numbers), pa.int64())], ["start", "n", "part", "number", "held"])

        return parts.mapInArrow(run, f"start {kind}, n long, part int, number long, held long")

    held: dict[int, int] = {}
    while True:
        ends = cuts(held).groupBy("part").agg(F.max("number").alias("windows"), F.max_by("held", F.struct(F.col("start").isNotNull(), "start")).alias("held")).orderBy("part").collect()
        found = {after.part: before.held for before, after in zip(ends, ends[1:], strict=False)}
        if found == held:
            break
        held = found
    # A range goes on in the last window of the one before it.
    first, total = {}, 0
    for row in ends:
        first[row.part] = total
        total += row.windows
    numbers = events.sparkSession.createDataFrame(list(first.items()) or [(0, 0)], "part int, first long")
    numbered = cuts(held).join(F.broadcast(numbers), "part").select((F.col("first") + F.col("number")).alias("window_no"), "start", "n")
    return numbered.groupBy("window_no").agg(F.min("start").alias("start"), F.max("start").alias("last"), F.sum("n").alias("n"))


def split_window(spark: SparkSession, start: str, end: str, n: int, min_seconds: int) -> DataFrame:
    """Equal contiguous windows in whole seconds, none below the minimum."""
    edges = spark.sql("SELECT unix_seconds(timestamp :a) AS a, unix_seconds(timestamp :b) AS b".replace(":a", f"'{start}'").replace(":b", f"'{end}'"))
    parts = F.greatest(F.lit(1), F.least(F.lit(n), F.floor((F.col("b") - F.col("a")) / min_seconds).cast("int")))
    rows = edges.withColumn("n", parts).select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    at = lambda i: F.timestamp_seconds(F.col("a") + F.floor((F.col("b") - F.col("a")) * i / F.col("n")))
    return rows.select("i", at(F.col("i")).alias("start"), at(F.col("i") + 1).alias("end"))


def hash_range_filter(df: DataFrame, key: list[str], low: int, high: int) -> DataFrame:
    """A worker's share by 32-bit key hash."""
    return df.where(F.pmod(F.xxhash64(*key), F.lit(2**32)).between(low, high))


def realtime_plus_delayed(fast: DataFrame, slow: DataFrame, key: list[str], ts: str) -> DataFrame:
    """Union of a lossy fast feed and a complete late one without what was already emitted.

    A late row is dropped if the fast feed has its key at the same or a newer time.
    """
    seen = fast.groupBy(*key).agg(F.max(ts).alias("_seen"))
    late = slow.join(seen, key, "left").where(F.col("_seen").isNull() | (F.col("_seen") < F.col(ts))).drop("_seen")
    return fast.unionByName(late)


def finished_folders(listing: DataFrame, folder: str, created: str, has_manifest: str, settle: str, now: Column) -> DataFrame:
    """Folders to read, wait for or skip (S21): one without a manifest is skipped once its successor has settled."""
    successor = F.lead(created).over(Window.orderBy(folder))
    state = F.when(F.col(has_manifest), "read").when(successor <= now - F.expr(f"INTERVAL {settle}"), "skip").otherwise("wait")
    waiting = F.max((state == "wait").cast("int")).over(Window.orderBy(folder).rowsBetween(Window.unboundedPreceding, -1))
    return listing.withColumn("action", F.when(F.coalesce(waiting, F.lit(0)) == 1, "wait").otherwise(state))
