"""Structured Streaming forms of the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from deltaloom.operators.merging import delete_by_key, load_existing, merge_bounds, within_bounds
from deltaloom.operators.reduction import reduce_collection


def hourly_stream(events: DataFrame, ts: str, keys: list[str], value: str, late: str = "15 minutes") -> DataFrame:
    """Complete hours of a stream; rows later than the watermark are dropped."""
    windows = events.withWatermark(ts, late).groupBy(F.window(ts, "1 hour").alias("w"), *keys)
    return windows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("decimal(18,4)")).alias("total")).select(F.col("w.start").alias("hour"), *keys, "n", "total")


def dedup_emitted(feed: DataFrame, key: str, ts: str, order: str = "fast", keep: str = "2 hours") -> DataFrame:
    """A stream of fast and late rows without late ones that were emitted at the same or a newer time.

    State per key: the newest time emitted, forgotten ``keep`` after the watermark passed it.
    ``order`` is a boolean column, true for the fast feed, which always passes.
    """
    schema: StructType = feed.schema
    keep_ms = int(pd.Timedelta(keep).total_seconds() * 1000)

    def pick(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        newest = state.get[0] if state.exists else -1
        for rows in batches:
            rows = rows.sort_values([ts, order], ascending=[True, False])
            micros = rows[ts].astype("datetime64[us]").astype("int64")
            passed = []
            for at, fast in zip(micros, rows[order], strict=True):
                passed.append(bool(fast) or at > newest)
                newest = max(newest, at)
            yield rows[passed]
        state.update((int(newest),))
        state.setTimeoutTimestamp(max(int(newest // 1000), state.getCurrentWatermarkMs()) + keep_ms)

    grouped = feed.withWatermark(ts, keep).groupBy(key)
    return grouped.applyInPandasWithState(pick, schema, "newest long", "append", GroupStateTimeout.EventTimeTimeout)


def materialize_stream(events: DataFrame, read: Callable[[], DataFrame | None], merge: Callable[[DataFrame, str], object], name: str, keys: list[str], order: list[str], strategies: dict[str, str], checkpoint: str, op: str | None = None):
    """A change stream kept as a reduced table: each micro-batch is reduced with the loaded rows of its keys, merged and committed once.

    ``read`` gives the target, None while there is none; its scan is pruned to the bounds of the batch's keys. ``merge`` takes
    the reduced rows, with ``_gone`` for deleted keys, and a batch id, which it must apply once however often it comes.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            target = read()
            bounded = None if target is None else within_bounds(target, merge_bounds(df, keys))
            merge(reduced_with_loaded(bounded, df, keys, order, strategies, op), f"{name}-{batch_id}")
        finally:
            df.unpersist()

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def reduced_with_loaded(target: DataFrame | None, batch: DataFrame, keys: list[str], order: list[str], strategies: dict[str, str], op: str | None = None) -> DataFrame:
    """One row for each key of a batch: the target's row, as the oldest, and the batch reduced together.

    Columns are the keys, those of ``strategies`` and ``_gone``, true for a key whose last event
    is a delete. So batches one after the other give what one batch of all their rows gives.
    """
    flag = F.col(op) == "d" if op else F.lit(False)
    rows = batch.withColumns({"_turn": F.lit(1), "_delete": F.coalesce(flag, F.lit(False))})
    if target is not None:
        loaded = load_existing(target, batch, keys).withColumns({"_turn": F.lit(0), "_delete": F.lit(False)})
        rows = loaded.unionByName(rows, allowMissingColumns=True)
    kept = reduce_collection(rows, keys, ["_turn", *order], strategies, F.col("_delete")).withColumn("_gone", F.lit(False))
    gone = delete_by_key(batch.select(*keys).distinct(), kept, keys).withColumn("_gone", F.lit(True))
    return kept.unionByName(gone, allowMissingColumns=True)
