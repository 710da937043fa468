"""Transactions that go on over micro-batches: rows wait for their commit in the stream's state."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

#: The state store that keeps lists; a session that buffers transactions needs it.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Buffer(StatefulProcessor):
    def __init__(self, schema: StructType, kind: str, position: str):
        self.schema, self.kind, self.position = schema, kind, position

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", self.schema)
        self.pending = handle.getValueState("pending", StructType([StructField("start", LongType()), StructField("n", LongType())]))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        # Each call on the state is a round trip to the JVM, so it is asked once a batch and touched only where it holds rows.
        waiting: list[Row] = []
        held = self.pending.exists()
        for row in sorted(rows, key=lambda r: r[self.position]):
            if row[self.kind] not in ("commit", "rollback"):
                waiting.append(row)
                continue
            if row[self.kind] == "commit":
                if held:
                    yield from (Row(**dict(zip(self.schema.names, kept))) for kept in self.rows.get())
                yield from waiting
            waiting = []
            if held:
                self.rows.clear()
                self.pending.clear()
                held = False
        if waiting:
            start, n = self.pending.get() if held else (waiting[0][self.position], 0)
            self.pending.update((min(start, waiting[0][self.position]), n + len(waiting)))
            self.rows.appendList([tuple(row) for row in waiting])

    def close(self) -> None:
        pass


def committed_stream(log: DataFrame, txid: str, kind: str, position: str) -> DataFrame:
    """Rows of a streaming change log once their transaction commits, in order inside it.

    ``kind`` is ``commit`` or ``rollback`` in the rows that end a transaction, which are left
    out; ``position`` is a long that rises in the log. Rows of a rollback go. A transaction without an end waits in
    the state, with its first position and number of rows; an id that comes again after its end
    is a new transaction. However the log is cut into batches, the same rows come out. A transaction's rows of
    one batch are one group in memory; those of earlier batches are a list in RocksDB.
    """
    return log.groupBy(txid).transformWithState(_Buffer(log.schema, kind, position), log.schema, "Append", "None")


def pending_transactions(spark: SparkSession, checkpoint: str, txid: str) -> DataFrame:
    """(txid, start, n) of the transactions that wait in a stopped stream's state."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "pending").load()
    return state.selectExpr(f"key.{txid} AS {txid}", "value.start AS start", "value.n AS n")
