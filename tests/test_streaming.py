import random
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Row
from pyspark.sql.types import LongType, StringType, StructField, StructType

from deltaloom.streaming import capture, transactions

LOG = StructType([StructField("pos", LongType()), StructField("v", StringType())])


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    pq.write_table(pa.table({"pos": pa.array([r[0] for r in rows], pa.int64()), "v": [r[1] for r in rows]}), folder / name)


def rows_of(spark, path, *columns):
    return sorted(tuple(r) for r in spark.read.parquet(path).select(*columns).collect())


def test_cursor_goes_on_over_three_runs(spark, tmp_path):
    log, out, check = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "check")

    def run(horizon=None):
        capture.run_to_files(capture.read_cursor(spark, capture.ParquetLog(str(log), "pos", 0, horizon), LOG), out, check)
        return rows_of(spark, out, "pos", "v")

    put(log, "a.parquet", [(1, "a"), (2, "b"), (3, None)])
    assert run(2) == [(1, "a"), (2, "b")]
    put(log, "b.parquet", [(4, "d"), (9, "e")])
    assert [p for p, _ in run()] == [1, 2, 3, 4, 9]
    put(log, "c.parquet", [(10, "f")])
    assert [p for p, _ in run()] == [1, 2, 3, 4, 9, 10]
    assert [p for p, _ in run()] == [1, 2, 3, 4, 9, 10]


def test_cursor_that_falls_fails(spark, tmp_path):
    log, out, check = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "check")
    put(log, "a.parquet", [(5, "a")])
    capture.run_to_files(capture.read_cursor(spark, capture.ParquetLog(str(log), "pos", 0), LOG), out, check)
    put(log, "a.parquet", [(3, "a")])
    with pytest.raises(Exception, match="fell from 5 to 3"):
        capture.run_to_files(capture.read_cursor(spark, capture.ParquetLog(str(log), "pos", 0), LOG), out, check)


class Items(capture.Client):
    """Items of a list; ``latest`` counts up to a bound."""

    def __init__(self, items, upto=9):
        self.items, self.upto = items, upto

    def subtasks(self):
        return ["one", "two"]

    def start(self, subtask):
        return 0

    def latest(self, subtask):
        return self.upto if subtask == "one" else None

    def fetch(self, subtask, after, upto, share):
        for item in self.items:
            yield capture.Cursor(item) if isinstance(item, int) else pa.RecordBatch.from_pydict({"pos": [int(x) for x in item], "v": list(item)})


@pytest.mark.parametrize("items,error", [(["12", 5, "7", 9], None), (["12", 5, "7", 5, 9], "not above"), (["12", 9, "3"], "no closing"), (["12"], "no closing"), (["12", 5], "no closing")])
def test_batches_need_a_closing_cursor(spark, tmp_path, items, error):
    run = lambda: capture.run_to_files(capture.read_cursor(spark, Items(items), LOG), str(tmp_path / "o"), str(tmp_path / "c"))
    if error:
        with pytest.raises(Exception, match=error):
            run()
        assert not list((tmp_path / "o").glob("*.parquet"))
    else:
        run()
        assert [p for p, _ in rows_of(spark, str(tmp_path / "o"), "pos", "v")] == [1, 2, 7]


@pytest.mark.parametrize("monotonic", [False, True])
def test_sweeps_go_on_over_three_runs(spark, tmp_path, monotonic):
    root, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    schema = StructType([StructField("id", LongType()), StructField("v", StringType())])

    def run(lag=0.0):
        capture.run_to_files(capture.read_sweep(spark, str(root), "json", schema, monotonic, lag), out, check)
        return [(f.rsplit("/", 1)[1], n, i, v) for f, n, i, v in rows_of(spark, out, "file", "offset", "id", "v")]

    root.mkdir()
    (root / "b.jsonl").write_text('{"id":1,"v":"x"}\n{"id":2,"more":5}\n')
    (root / "empty.jsonl").write_text("")
    (root / "_tmp.jsonl").write_text('{"id":9}\n')
    time.sleep(0.01)
    first = [("b.jsonl", 0, 1, "x"), ("b.jsonl", 1, 2, None)]
    assert run() == first
    time.sleep(0.02)
    (root / "c.jsonl").write_text('{"id":3}\n')
    (root / "a.jsonl").write_text('{"id":4}\n')
    if not monotonic:
        with pytest.raises(Exception, match="fell from"):
            capture.run_to_files(capture.read_sweep(spark, str(root), "json", schema, False, 3600), out, str(tmp_path / "check"))
        check = str(tmp_path / "check2")
        out = str(tmp_path / "out2")
        (root / "c.jsonl").rename(tmp_path / "c.jsonl")
        (root / "a.jsonl").rename(tmp_path / "a.jsonl")
        assert run() == first
        (tmp_path / "c.jsonl").write_text('{"id":3}\n')
        (tmp_path / "a.jsonl").write_text('{"id":4}\n')
        (tmp_path / "c.jsonl").rename(root / "c.jsonl")
        (tmp_path / "a.jsonl").rename(root / "a.jsonl")
    later = [("c.jsonl", 0, 3, None)] if monotonic else [("a.jsonl", 0, 4, None), ("c.jsonl", 0, 3, None)]
    assert run() == sorted(first + later)
    assert run() == sorted(first + later)


KINDS = StructType([StructField("tx", LongType()), StructField("pos", LongType()), StructField("kind", StringType()), StructField("v", StringType()), StructField("n", LongType())])


def plain_transactions(log):
    held, out = {}, []
    for tx, pos, kind, v, n in log:
        if kind == "commit":
            out += held.pop(tx, [])
        elif kind == "rollback":
            held.pop(tx, None)
        else:
            held.setdefault(tx, []).append((tx, pos, kind, v, n))
    return sorted(out), sorted((tx, rows[0][1], len(rows)) for tx, rows in held.items())


@pytest.mark.parametrize("seed", [1, 2])
def test_any_cut_of_a_log_gives_the_same_transactions(spark, tmp_path, seed):
    rng = random.Random(seed)
    log = [(rng.randrange(6), pos, rng.choice(["row", "row", "row", "row", "commit", "rollback"]), rng.choice([None, "x", "é"]), rng.choice([None, pos])) for pos in range(120)]
    want, waiting = plain_transactions(log)
    assert want and waiting
    src, out, check = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "check")
    src.mkdir()
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", transactions.STORE)
    try:
        at = 0
        for k, cut in enumerate(sorted(rng.sample(range(1, 120), 2)) + [120]):
            part = log[at:cut]
            pq.write_table(pa.table({f.name: pa.array([r[i] for r in part], pa.string() if isinstance(f.dataType, StringType) else pa.int64()) for i, f in enumerate(KINDS)}), src / f"{k}.parquet")
            at = cut
            stream = spark.readStream.schema(KINDS).parquet(str(src))
            capture.run_to_files(transactions.committed_stream(stream, "tx", "kind", "pos"), out, check)
        assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == want
        assert sorted(tuple(r) for r in transactions.pending_transactions(spark, check, "tx").collect()) == waiting
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)


class _CountedState:
    """A list or value state in memory that counts its calls."""

    def __init__(self):
        self.held, self.calls = None, 0

    def __getattr__(self, name):
        def call(*value):
            self.calls += 1
            if name == "exists":
                return self.held is not None
            if name == "get":
                return self.held if isinstance(self.held, tuple) else iter(self.held or [])
            self.held = {"clear": lambda: None, "update": lambda: value[0], "appendList": lambda: (self.held or []) + value[0]}[name]()

        return call


def test_state_is_touched_once_a_batch_however_many_transactions_end():
    buffer = transactions._Buffer(KINDS, "kind", "pos")
    buffer.rows, buffer.pending = _CountedState(), _CountedState()
    row = lambda pos, kind: Row(tx=1, pos=pos, kind=kind, v=None, n=None)
    assert list(buffer.handleInputRows((1,), iter([row(0, "row")]), None)) == []
    assert buffer.pending.held == (0, 1)
    batch = [row(at, kind) for at, kind in enumerate(["row", "commit", "row", "rollback"] * 50, 1)]
    found = list(buffer.handleInputRows((1,), iter(batch), None))
    assert [r.pos for r in found] == [0, *range(1, 201, 4)] and buffer.pending.held is None and buffer.rows.held is None
    assert buffer.rows.calls + buffer.pending.calls <= 8
