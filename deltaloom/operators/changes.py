"""Change events: shape, backfill, transactions, snapshots."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.session import settled

#: Scan positions that are broadcast, a few bytes each.
MARKS = 10_000


def change_event(df: DataFrame, op: str, before: str, after: str, source: list[str]) -> DataFrame:
    """Root columns of the after image (of the before image for deletes) and a ``_meta`` struct."""
    body = F.when(F.col(op) == "d", F.col(before)).otherwise(F.col(after))
    meta = F.struct(F.col(op).alias("op"), F.struct(*source).alias("source"), F.when(F.col(op) == "u", F.col(before)).alias("before"))
    return df.select(body.alias("_row"), meta.alias("_meta")).select("_row.*", "_meta")


def precise_backfill(chunks: DataFrame, events: DataFrame, key: str, position: str, partition: str | None = None) -> DataFrame:
    """Events that a running backfill lets pass.

    ``chunks``: (position, upper), the key up to which the scan stood from that position on, null
    upper when the scan is done. An event passes if its key was scanned already, as the last chunk at or before its
    position says; per ``partition`` (table) the scan state is its own, and a null partition has none. Of chunks at one position the one that got furthest holds.
    Up to MARKS chunks, counted first, are one broadcast array for each partition that every event searches by
    halves; beyond, chunks and events are dealt by ranges of position (``last_before``).
    """
    side = [partition] if partition else []
    marks = chunks.groupBy(*side, position).agg(F.bool_or(F.col("upper").isNull()).alias("_done"), F.max("upper").alias("_upper"))
    marks = marks.select(*side, F.col(position).alias("_from"), F.when(~F.col("_done"), F.col("_upper")).alias("_upper"))
    if marks.limit(MARKS + 1).count() <= MARKS:
        lists = marks.groupBy(*side).agg(F.array_sort(F.collect_list(F.struct("_from", "_upper"))).alias("_marks")).withColumnsRenamed({p: "_side" for p in side})
        found = events.join(F.broadcast(lists), F.col(partition) == F.col("_side")) if partition else events.withColumn("_marks", lists.scalar())
        found = found.withColumn("_mark", F.get("_marks", searched("_marks", F.col(position), MARKS)))
    else:
        named = events.dropna(subset=side) if side else events
        found = last_before(named, marks.withColumnRenamed("_from", position), side, position, ["_upper"], "_mark")
    passed = F.col("_mark").isNotNull() & (F.col("_mark._upper").isNull() | (F.col(key) <= F.col("_mark._upper")))
    return found.where(passed).select(*events.columns)


def searched(marks: str, value: Column, most: int) -> Column:
    """Index of the last entry of a sorted array of structs whose ``_from`` is at or before a value, -1 without one: a binary search."""
    state = F.struct(F.lit(-1).alias("low"), F.size(marks).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        low = F.get(marks, middle)["_from"] <= value
        open_ = s["high"] - s["low"] > 1
        return F.struct(F.when(open_ & low, middle).otherwise(s["low"]).alias("low"), F.when(open_ & ~low, middle).otherwise(s["high"]).alias("high"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(most.bit_length() + 1)), state, halve)["low"]


def last_before(rows: DataFrame, marks: DataFrame, side: list[str], position: str, values: list[str], name: str) -> DataFrame:
    """Rows with the struct ``name`` of the values of the last mark at or before their position in their side, null without one.

    Rows and marks are dealt together by ranges of side and position, so a hot side is many tasks. Inside a range the last mark
    is a running value; the one before a range comes from the last marks of the ranges before it,
    a row for each range and side.
    """
    mark = F.struct(*[F.col(v) for v in values])
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    kinds = {"_mark": marks.select(mark.alias("m")).schema["m"].dataType, "_row": rows.select(row.alias("r")).schema["r"].dataType}
    keys = [F.col(s).alias(f"_s{i}") for i, s in enumerate(side)]
    both = marks.select(*keys, F.col(position).alias("_at"), F.lit(0).alias("_kind"), mark.alias("_mark"), F.lit(None).cast(kinds["_row"]).alias("_row"))
    both = both.unionByName(rows.select(*keys, F.col(position).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(kinds["_mark"]).alias("_mark"), row.alias("_row")))
    names = [f"_s{i}" for i in range(len(side))]
    dealt = settled(both.repartitionByRange(*names, "_at", "_kind").withColumn("_range", F.spark_partition_id()))
    inside = Window.partitionBy("_range", *names).orderBy("_at", "_kind")
    here = dealt.withColumn("_here", F.last("_mark", ignorenulls=True).over(inside)).where("_kind = 1")
    ranges = dealt.groupBy("_range", *names).agg(F.max_by("_mark", F.when(F.col("_kind") == 0, F.col("_at"))).alias("_end"))
    before = Window.partitionBy(*(names or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.select(F.col("_range").alias("_r"), *[F.col(n).alias(f"{n}_") for n in names], F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    joined = here.join(carried, [F.col("_range") == F.col("_r"), *[F.col(n).eqNullSafe(F.col(f"{n}_")) for n in names]], "left")
    return joined.select("_row.*", F.coalesce("_here", "_carried").alias(name))


#: Modes of a binding and states of a table.
MODES = ("", "Normal", "Precise", "Only Changes", "Without Primary Key")


def backfill_state(mode: Column, base_table: Column, unpredictable: Column, filtered: Column) -> Column:
    """State in which a pending table starts (C3): Ignore for what is no base table, else as the mode says.

    The automatic mode, an empty one, is precise unless the key's order can't be predicted or a
    backfill filter is set, where it is unfiltered. A null mode is automatic; an unknown one is an error.
    """
    chosen = F.coalesce(mode, F.lit(""))
    automatic = F.when(F.coalesce(unpredictable, F.lit(False)) | F.coalesce(filtered, F.lit(False)), "UnfilteredBackfill").otherwise("Backfill")
    by_mode = F.when(chosen == "", automatic).when(chosen == "Normal", "UnfilteredBackfill").when(chosen == "Precise", "Backfill").when(chosen == "Only Changes", "Active").when(chosen == "Without Primary Key", "KeylessBackfill")
    return F.when(~F.coalesce(base_table, F.lit(False)), "Ignore").otherwise(F.coalesce(by_mode, F.raise_error(F.concat(F.lit("invalid backfill mode "), chosen))))


def backfilled(scan: DataFrame, chunks: DataFrame, events: DataFrame, states: DataFrame, table: str, key: str, position: str) -> DataFrame:
    """Scan rows and the events that pass beside them, by the state of each table.

    ``states`` is (table, mode), a row a table and small. Precise backfills filter events by ``chunks`` (C2);
    unfiltered and keyless ones, and active tables, let all pass; active tables have no scan. Keyless scan rows get
    their number among equal rows as ``_meta.row``, as nothing else tells them apart. Tables that are ignored, missing or without a state have nothing.
    """
    named = F.broadcast(states.select(F.col(table), F.col("mode").alias("_mode")))
    rows, changes = scan.join(named, table), events.join(named, table)
    keyless = rows.where("_mode = 'KeylessBackfill'")
    numbered = keyless.withColumn("_meta", F.struct(F.row_number().over(Window.partitionBy(*[F.col(f"`{c}`") for c in scan.columns]).orderBy(F.lit(0))).alias("row")))
    keyed = rows.where(F.col("_mode").isin("Backfill", "UnfilteredBackfill")).withColumn("_meta", F.struct(F.lit(None).cast("int").alias("row")))
    free = changes.where(F.col("_mode").isin("Active", "UnfilteredBackfill", "KeylessBackfill")).drop("_mode")
    precise = precise_backfill(chunks, changes.where("_mode = 'Backfill'").drop("_mode"), key, position, table)
    return numbered.unionByName(keyed).drop("_mode").unionByName(free.unionByName(precise), allowMissingColumns=True)


def unfiltered_backfill(chunks: DataFrame, events: DataFrame) -> DataFrame:
    """Scan rows and all changes; reducing by key makes them converge."""
    return chunks.unionByName(events, allowMissingColumns=True)


def scan_order_violations(df: DataFrame, key: list[str], arrival: list[str], partition: str) -> DataFrame:
    """Rows whose key is below the one before in arrival order (C4)."""
    over = Window.partitionBy(partition).orderBy(*arrival)
    return df.withColumn("_before", F.lag(F.struct(*key)).over(over)).where(F.struct(*key) < F.col("_before")).drop("_before")


def pack_long(c: Column) -> Column:
    """Hex digits that sort as the number does; null sorts first. Join several to pack a key."""
    return F.coalesce(F.concat(F.lit("01"), F.lpad(F.hex(c.cast("long").bitwiseXOR(F.lit(-(2**63)))), 16, "0")), F.lit("00"))


def pack_string(c: Column) -> Column:
    """Hex digits that sort as the UTF-8 bytes do, a prefix before what it starts; null first."""
    return F.coalesce(F.concat(F.lit("01"), F.hex(F.encode(c, "UTF-8")), F.lit("00")), F.lit("00"))


def pair_update_halves(df: DataFrame, row_id: str, seq: str, action: str, is_update: str, image: list[str]) -> DataFrame:
    """DELETE and INSERT halves of one update become one row with before and after.

    Rows without an action are clone rows and count as inserts.
    """
    act = F.coalesce(F.col(action), F.lit("INSERT"))
    old, new = F.max(F.when(act == "DELETE", F.struct(*image))), F.max(F.when(act == "INSERT", F.struct(*image)))
    both = df.groupBy(row_id, seq).agg(F.bool_or(F.coalesce(F.col(is_update), F.lit(False))).alias("_update"), old.alias("before"), new.alias("after"))
    op = F.when(F.col("before").isNotNull() & F.col("after").isNotNull(), "u").when(F.col("after").isNotNull(), "c").otherwise("d")
    return both.select(row_id, seq, op.alias("op"), "before", "after")


def changes_join_current(changes: DataFrame, base: DataFrame, keys: list[str], version: str, op: str, after: int, upto: int) -> DataFrame:
    """Latest change of each key in (after, upto] with the live row; deletes keep only the keys."""
    latest = changes.where((F.col(version) > after) & (F.col(version) <= upto)).groupBy(*keys).agg(F.max_by(F.col(op), F.col(version)).alias("_op"), F.max(version).alias(version))
    code = F.when(F.col("_op") == "I", "c").when(F.col("_op") == "U", "u").otherwise("d")
    joined = latest.join(base, keys, "left")
    values = [F.when(F.col("_op") != "D", F.col(c)).alias(c) for c in base.columns if c not in keys]
    return joined.select(*keys, code.alias("op"), version, *values)


def fill_unchanged(df: DataFrame, before: str, after: str, unchanged: str, columns: list[str]) -> list[Column]:
    """Columns named in the array ``unchanged`` come from the before image."""
    return [F.when(F.array_contains(F.col(unchanged), c), F.col(f"{before}.{c}")).otherwise(F.col(f"{after}.{c}")).alias(c) for c in columns]


#: A step of a key path: a plain name, a name in double quotes, or a place in an array.
PATH_STEP = re.compile(r'\.([^.\[\]"]+)|\."((?:[^"\\]|\\.)*)"|\[(\d+)\]')


def key_path(path: str) -> list[str | int]:
    """Names and places of ``$.a."b c"[0]``; ``$`` alone has none."""
    out: list[str | int] = []
    at = 1
    while at < len(path):
        step = PATH_STEP.match(path, at)
        if step is None:
            raise ValueError(f"no key path: {path}")
        name, quoted, place = step.groups()
        out.append(int(place) if place is not None else name if name is not None else json.loads(f'"{quoted}"'))
        at = step.end()
    return out


def _edited(doc, op: str, path: list[str | int], value):
    """A document after one edit; an edit whose place is not there changes nothing."""
    if not path:
        return None if op == "remove" else value
    at = doc
    for name in path[:-1]:
        if not (name in at if isinstance(at, dict) else isinstance(at, list) and isinstance(name, int) and name < len(at)):
            return doc
        at = at[name]
    last = path[-1]
    if isinstance(at, list) and isinstance(last, int):
        if op == "insert":
            at.insert(last, value)
        elif last < len(at):
            at[last : last + 1] = [] if op == "remove" else [value]
    elif isinstance(at, dict) and isinstance(last, str):
        if op == "remove":
            at.pop(last, None)
        elif op == "insert" or last in at:
            at[last] = value
    return doc


@F.pandas_udf(T.StringType())
def apply_json_diff(base: pd.Series, diffs: pd.Series) -> pd.Series:
    """Replace, insert and remove at key paths like ``$.a.b``, ``$.a[1]``, ``$."a b"`` or ``$``, in order.

    A null document, or text that is no JSON, stays null unless an edit replaces ``$``. Edits of
    what is not there change nothing, but an insert adds a name. A path that can't be read
    fails the job, as the edits after it would meet another document.
    """
    out = []
    for text, steps in zip(base, diffs, strict=True):
        try:
            doc = None if text is None else json.loads(text)
        except ValueError:
            doc = None
        for step in steps if steps is not None else []:
            doc = _edited(doc, step["op"], key_path(step["path"]), None if step["value"] is None else json.loads(step["value"]))
        out.append(None if doc is None else json.dumps(doc, sort_keys=True, separators=(",", ":")))
    return pd.Series(out, dtype=object)


def drop_non_bound(events: DataFrame, bindings: DataFrame, table: str) -> DataFrame:
    """Events of tables that a binding takes; those of ignored or missing ones go."""
    return events.join(bindings.where(~F.col("mode").isin("Ignore", "Missing")).select(table), table, "left_semi")


def after_drops(bindings: DataFrame, events: DataFrame, discovered: DataFrame, table: str, dropped: Column) -> DataFrame:
    """(table, mode) after a batch (C10): bound tables that a drop event names become Missing, missing ones that are found again Pending.

    Ignored tables stay ignored. ``discovered`` has the tables that exist now; a table dropped in this batch waits for the next look.
    """
    gone = events.where(dropped).select(F.col(table).alias("_gone")).distinct()
    there = discovered.select(F.col(table).alias("_there")).distinct()
    both = bindings.join(gone, F.col(table) == F.col("_gone"), "left").join(there, F.col(table) == F.col("_there"), "left")
    state = F.when(F.col("mode") == "Ignore", "Ignore").when(F.col("_gone").isNotNull(), "Missing").when((F.col("mode") == "Missing") & F.col("_there").isNotNull(), "Pending").otherwise(F.col("mode"))
    return both.select(table, state.alias("mode"))


def committed_only(events: DataFrame, txid: str, is_commit: Column) -> DataFrame:
    """Rows of transactions with a commit row in the batch, commit rows left out (C11)."""
    commits = events.where(is_commit).select(txid).distinct()
    return events.where(~is_commit).join(commits, txid, "left_semi")


def snapshot_diff(current: DataFrame, previous_count: int, order: list[str], previous_digest: str | None = None) -> DataFrame:
    """Rows numbered from 0: ``c`` for new numbers, ``u`` for known ones, ``d`` for the missing tail.

    Numbers are given in ranges: counts of range partitions are summed, so no task
    orders the whole snapshot. With the ``digest`` that ``snapshot_digest`` gave for the snapshot before, an unchanged
    one gives no rows, and nothing is numbered.
    """
    if previous_digest is not None and snapshot_digest(current) == previous_digest:
        return current.limit(0).select("*", F.lit(0).cast("long").alias("row_id"), F.lit("").alias("op"))
    numbered = row_numbers(current, order)
    rows = numbered.withColumn("op", F.when(F.col("row_id") < previous_count, "u").otherwise("c"))
    n = numbered.count()
    tail = current.sparkSession.range(n, max(n, previous_count)).select(F.col("id").alias("row_id"), F.lit("d").alias("op"))
    return rows.unionByName(tail, allowMissingColumns=True)


def row_numbers(df: DataFrame, order: list[str]) -> DataFrame:
    """``row_id`` from 0 in order, by range partitions and their counts."""
    parts = settled(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    counts = parts.groupBy("_part").count()
    start = counts.withColumn("_start", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return parts.withColumn("_place", place).join(F.broadcast(start), "_part").withColumn("row_id", (F.col("_start") + F.col("_place")).cast("long")).drop("_part", "_place", "_start")


def content_digest(df: DataFrame) -> DataFrame:
    """(n, digest) of a frame as a multiset of rows, in whatever order they come; equal ones mean nothing to emit.

    The digest sums four 32-bit words of every row's SHA-256 in decimals, so rows that repeat don't cancel as they would under an
    exclusive or. With a column of row numbers the order of rows counts too.
    """
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"}), 256)
    words = df.select(row.alias("h")).select(*[F.conv(F.substring("h", 1 + 8 * i, 8), 16, 10).cast("decimal(10,0)").alias(f"w{i}") for i in range(4)])
    sums = words.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(f"w{i}").cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")).alias(f"w{i}") for i in range(4)])
    return sums.select("n", F.concat_ws("-", *[F.col(f"w{i}").cast("string") for i in range(4)]).alias("digest"))


def snapshot_digest(df: DataFrame) -> str:
    """Number and digest of a snapshot as one text, to be kept with it."""
    row = content_digest(df).first()
    return f"{row.n}:{row.digest}"


def incremental_capture(df: DataFrame, cursor: str, last, horizon) -> DataFrame:
    """Rows with last < cursor <= horizon; a null cursor in them is an error (C14)."""
    checked = F.when(F.col(cursor).isNull(), F.raise_error(F.lit(f"row without {cursor}"))).otherwise(F.col(cursor))
    return df.where((checked > F.lit(last)) & (checked <= F.lit(horizon)))


def backfill_plus_incremental(df: DataFrame, ts: str, cutoff) -> tuple[DataFrame, DataFrame]:
    """The part up to the cutoff and the part after it."""
    return df.where(F.col(ts) <= F.lit(cutoff)), df.where(F.col(ts) > F.lit(cutoff))


def tombstones(df: DataFrame, keys: list[str]) -> DataFrame:
    """Delete documents of keys; a null key is an error (C17)."""
    return df.select(*[F.when(F.col(k).isNull(), F.raise_error(F.lit(f"null key {k}"))).otherwise(F.col(k)).alias(k) for k in keys], F.struct(F.lit("d").alias("op")).alias("_meta"))


def join_fragments(df: DataFrame, event: str, fragment: str, body: str) -> DataFrame:
    """Split events put together: maps of fragments joined in order, later ones win."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(fragment).alias("f"), F.map_entries(body).alias("b"))))
    entries = F.flatten(F.transform(ordered, lambda x: x["b"]))
    last = F.aggregate(entries, F.create_map().cast("map<string,string>"), lambda m, e: F.map_concat(F.map_filter(m, lambda k, v: k != e["key"]), F.map_from_arrays(F.array(e["key"]), F.array(e["value"]))))
    return df.groupBy(event).agg(last.alias(body))


def oversize_placeholder(c: Column, limit: int, is_json: bool = False) -> Column:
    """Text cut to at most ``limit`` bytes (a cut code point goes); JSON replaced by a placeholder."""
    if is_json:
        return F.when(F.octet_length(c) > limit, F.concat(F.lit('{"truncated":true,"original_size":'), F.octet_length(c).cast("string"), F.lit("}"))).otherwise(c)
    raw = F.encode(c, "UTF-8")
    # A code point has at most four bytes: one of four cuts ends between two.
    cuts = [F.try_validate_utf8(F.substring(raw, 1, max(limit - back, 0)).cast("string")) for back in range(4)]
    return F.when(F.octet_length(c) <= limit, c).otherwise(F.coalesce(*cuts))


def multi_log_merge(logs: DataFrame, thread: str, position: str) -> DataFrame:
    """Rows up to the lowest position that every thread has covered (C20)."""
    covered = logs.groupBy(thread).agg(F.max(position).alias("p")).agg(F.min("p").alias("_covered"))
    return logs.join(F.broadcast(covered), F.col(position) <= F.col("_covered")).drop("_covered")


def resolve_transactions(log: DataFrame, xid: str, kind: str, position: str) -> DataFrame:
    """State of each transaction: rolled back, committed, or pending with its start and size."""
    counted = log.groupBy(xid).agg(
        F.count_if(F.col(kind) == "rollback").alias("rollbacks"), F.count_if(F.col(kind) == "commit").alias("commits"), F.min(position).alias("start"), F.count_if(~F.col(kind).isin("commit", "rollback")).alias("n")
    )
    state = F.when(F.col("rollbacks") > 0, "rolled back").when(F.col("commits") > 0, "committed").otherwise("pending")
    return counted.select(xid, state.alias("state"), "start", "n")
