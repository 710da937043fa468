"""Items of an array inside one huge JSON document, read by many tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a range that one task scans, and bytes beyond its edges that are read at a time.
RANGE, BEYOND = 64 << 20, 1 << 16
#: Ranges that have a task each; where there are more, tasks share them: one for RANGE bytes, and enough for all cores.
TASKS = 512

_QUOTE, _BACKSLASH = ord('"'), ord("\\")
_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]], _STEP[[ord("}"), ord("]")]] = 1, -1


def _quotes(data: np.ndarray) -> np.ndarray:
    """Places of quotes that no backslash escapes; the data must begin outside an escape."""
    places = np.flatnonzero(data == _QUOTE)
    if not (data == _BACKSLASH).any():
        return places
    at = np.arange(len(data))
    last_other = np.maximum.accumulate(np.where(data == _BACKSLASH, -1, at))
    before = np.where(places > 0, last_other[np.maximum(places - 1, 0)], -1)
    return places[(places - 1 - before) % 2 == 0]


def outside(data: np.ndarray, in_string: bool) -> np.ndarray:
    """Which bytes are outside strings; quotes themselves are inside."""
    turns = np.zeros(len(data) + 1, np.int8)
    turns[_quotes(data) + 1] = 1
    inside = (np.cumsum(turns[:-1], dtype=np.int64) + in_string) % 2 == 1
    return ~inside & (data != _QUOTE)


class _Source:
    """Byte ranges of a file in any store that pyarrow reads."""

    def __init__(self, path: str):
        self.fs, self.path = pyarrow.fs.FileSystem.from_uri(path)
        self.file = self.fs.open_input_file(self.path)
        self.size = self.file.size()

    def read(self, start: int, end: int) -> np.ndarray:
        self.file.seek(start)
        return np.frombuffer(self.file.read(max(min(end, self.size) - start, 0)), np.uint8)

    def escaped(self, at: int) -> bool:
        """Whether the byte at a place is escaped: an odd run of backslashes ends before it."""
        run, end, size = 0, at, 64
        while end > 0:
            data = self.read(max(end - size, 0), end)
            others = np.flatnonzero(data != _BACKSLASH)
            run += len(data) if not len(others) else len(data) - 1 - int(others[-1])
            if len(others):
                break
            end, size = end - len(data), BEYOND
        return run % 2 == 1

    def window(self, start: int, end: int) -> tuple[np.ndarray, int]:
        """Bytes of a range from its first unescaped one on, and that one's place; the skipped one is part of a string."""
        first = start + self.escaped(start)
        return self.read(first, end), first


def _over(spark: SparkSession, path: str, ranges: DataFrame, schema: str, find) -> DataFrame:
    """``find(source, number, start, end, in_string, depth)`` rows of each range."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = _Source(path)
        kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
        types = [kinds[x.split()[1]] for x in schema.split(", ")]
        for batch in batches:
            for row in batch.to_pylist():
                for rows in find(source, **row):
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types, strict=True)], names)

    return ranges.mapInArrow(run, schema)


def _summary(source: _Source, number: int, start: int, end: int):
    """Parity of the range's quotes, and its change of depth if it begins outside or inside a string."""
    data, _ = source.window(start, end)
    step = _STEP[data].astype(np.int64)
    free = outside(data, False)
    text = outside(data, True)
    yield [(number, start, end, len(_quotes(data)) % 2, int(step[free].sum()), int(step[text].sum()))]


def _depths(source: _Source, start: int, end: int, in_string: int, depth: int) -> tuple[np.ndarray, int, np.ndarray, np.ndarray]:
    """Bytes of a range, their first place, which are outside strings, and the depth after each."""
    data, first = source.window(start, end)
    free = outside(data, bool(in_string))
    return data, first, free, depth + np.cumsum(np.where(free, _STEP[data], 0), dtype=np.int64)


def _key_places(name: str, level: int, after: int):
    """Places after the colon of keys of this name at a depth, beyond ``after``."""
    text = b'"' + name.encode() + b'"'

    def find(source: _Source, number: int, start: int, end: int, in_string: int, depth: int):
        data, first, free, depths = _depths(source, start, end, in_string, depth)
        quotes = _quotes(data)
        opens = quotes[(np.arange(len(quotes)) + in_string) % 2 == 0]
        opens = opens[(depths[opens] == level) & (opens + first > after)] if len(opens) else opens
        for at in opens.tolist():
            if len(data) - at >= len(text) and data[at : at + len(text)].tobytes() != text:
                continue
            head, size = b"", BEYOND
            while True:
                head = source.read(first + at, first + at + len(text) + size).tobytes()
                rest = head[len(text) :].lstrip(b" \t\r\n")
                if rest or len(head) < len(text) + size:
                    break
                size *= 2
            if head.startswith(text) and rest.startswith(b":"):
                yield [(first + at + head.index(b":", len(text)) + 1,)]
                return  # an object has a name once; the first is the one in document order

    return find


def _end_of(level: int, after: int):
    """The first place beyond ``after`` where the depth falls below a level."""

    def find(source: _Source, number: int, start: int, end: int, in_string: int, depth: int):
        if end <= after:
            return
        _, first, _, depths = _depths(source, start, end, in_string, depth)
        below = np.flatnonzero(depths < level) + first
        below = below[below > after]
        if len(below):
            yield [(int(below[0]),)]

    return find


def _item_texts(level: int, begin: int, stop: int):
    """Texts of the array's items that begin in a range: after its bracket or a comma at its level."""

    def find(source: _Source, number: int, start: int, end: int, in_string: int, depth: int):
        if end <= begin or start >= stop:
            return
        data, first, free, depths = _depths(source, start, end, in_string, depth)
        at = np.flatnonzero(free & (data == ord(",")) & (depths == level)) + first
        cuts = at[(at > begin) & (at < stop)].tolist()
        starts = ([begin + 1] if first <= begin < end else []) + [c + 1 for c in cuts]
        rows, size = [], 0
        for k, a in enumerate(starts):
            b = starts[k + 1] - 1 if k + 1 < len(starts) else _item_end(source, a, level, stop)
            text = (data[a - first : b - first] if b <= first + len(data) and a >= first else source.read(a, b)).tobytes().decode()
            if text.strip():
                rows.append((a, text))
                size += len(text)
            if size > 4 << 20:
                yield rows
                rows, size = [], 0
        if rows:
            yield rows

    return find


def _item_end(source: _Source, start: int, level: int, stop: int) -> int:
    """Where an item ends that goes on beyond its range."""
    at, in_string, depth = start, False, level
    while at < stop:
        data, first = source.window(at, min(at + BEYOND, stop))
        free = outside(data, in_string)
        depths = depth + np.cumsum(np.where(free, _STEP[data], 0), dtype=np.int64)
        ends = np.flatnonzero(free & (data == ord(",")) & (depths == level))
        if len(ends):
            return first + int(ends[0])
        if len(data):
            in_string, depth = bool((len(_quotes(data)) + in_string) % 2), int(depths[-1])
        at = first + len(data)
    return stop


def read_large_json_items(spark: SparkSession, path: str, item_path: str, size: int = RANGE) -> tuple[DataFrame, str]:
    """Items of the array at a dotted path of one JSON document as (at, item) JSON texts, and the document without them.

    ``path`` is a file of a store that pyarrow reads, in UTF-8. Its ranges of ``size`` bytes are scanned by a task
    each, or where they are more than TASKS by tasks of several: first for the parity of their quotes and their change of depth, of which prefix sums give each range's state at
    its start, then for the array and its items. An item that crosses a range's end is read by the range it begins in.
    ``at`` is the item's place, which orders them. A path that leads to no array is an error. The rest of the document, with the array
    empty, is one text on the driver.
    """
    whole = _Source(path)
    n = max(1, -(-whole.size // size))
    tasks = n if n <= TASKS else min(n, max(2 * spark.sparkContext.defaultParallelism, -(-whole.size // RANGE)))
    ranges = spark.range(n, numPartitions=tasks).selectExpr("id AS number", f"id * {size} AS start", f"least((id + 1) * {size}, {whole.size}) AS end")
    found = _over(spark, path, ranges, "number long, start long, end long, odd long, free long, text long", _summary).orderBy("number").collect()
    states, in_string, depth = [], 0, 0
    for r in found:
        states.append((r.number, r.start, r.end, in_string, depth))
        depth += r.text if in_string else r.free
        in_string ^= r.odd
    known = spark.createDataFrame(states, "number long, start long, end long, in_string int, depth long").repartition(tasks, "number")
    place, level = -1, 0
    for name in item_path.split("."):
        level += 1
        limit = None if place < 0 else _over(spark, path, known, "at long", _end_of(level, place + _value(whole, place))).agg(F.min("at")).first()[0]
        at = _over(spark, path, known, "at long", _key_places(name, level, place)).agg(F.min("at")).first()[0]
        if at is None or (limit is not None and at > limit):
            raise ValueError(f"{path} has no {item_path}")
        place = at
    begin = place + _value(whole, place)
    if whole.read(begin, begin + 1).tobytes() != b"[":
        raise ValueError(f"{item_path} of {path} is no array")
    stop = _over(spark, path, known, "at long", _end_of(level + 1, begin)).agg(F.min("at")).first()[0]
    if stop is None:
        raise ValueError(f"{path} ends inside {item_path}")
    rest = whole.read(0, begin + 1).tobytes() + whole.read(stop, whole.size).tobytes()
    return _over(spark, path, known, "at long, item string", _item_texts(level + 1, begin, stop)), rest.decode()


def _value(source: _Source, at: int) -> int:
    """White space before the value at a place."""
    n = 0
    while at + n < source.size:
        data = source.read(at + n, at + n + BEYOND)
        solid = np.flatnonzero(~np.isin(data, list(b" \t\r\n")))
        if len(solid):
            return n + int(solid[0])
        n += len(data)
    return n
