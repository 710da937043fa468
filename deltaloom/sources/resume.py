"""Scans that go on where they stopped: every step's rows and the state after them become visible together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class ResumableScan:
    """A scan of named parts of a table (segments, subtasks) with a cursor and a done flag each.

    A step takes the next rows of every unfinished part in key order and writes them to
    ``path/rows/step=N``; then one small file ``path/state/step=N`` makes the step and the cursors after
    it valid. A step that was cut off before that is written anew by the next run, so no row is lost or comes twice.
    Keys must be unique and not null inside a part; rows that a table gets behind a part's cursor are not
    seen, as in any keyset scan. Parts are few; their names and cursors come to the driver.
    """

    def __init__(self, spark: SparkSession, path: str, part: str, keys: list[str]):
        self.spark, self.path, self.part, self.keys = spark, path.rstrip("/"), part, keys

    def _steps(self) -> list[int]:
        """Numbers of the steps whose state was written."""
        try:
            files = self.spark.read.parquet(f"{self.path}/state")
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
                return []
            raise
        return sorted({int(f.rsplit("/step=", 1)[1].split("/")[0]) for f in files.inputFiles()})

    def state(self) -> DataFrame | None:
        """(part, cursor struct, done) after the last step, None before the first."""
        steps = self._steps()
        return self.spark.read.parquet(f"{self.path}/state/step={steps[-1]}") if steps else None

    def read(self) -> DataFrame | None:
        """The rows of all valid steps with their ``step``."""
        steps = self._steps()
        return self.spark.read.option("basePath", f"{self.path}/rows").parquet(*[f"{self.path}/rows/step={n}" for n in steps]) if steps else None

    def pending(self, table: DataFrame) -> DataFrame:
        """Rows of unfinished parts after their cursors."""
        state = self.state()
        if state is None:
            return table
        known = state.select(F.col("part").alias("_part"), "cursor", "done")
        rows = table.join(F.broadcast(known), F.col(self.part).eqNullSafe(F.col("_part")), "left")
        left = ~F.coalesce("done", F.lit(False)) & (F.col("cursor").isNull() | (F.struct(*self.keys) > F.col("cursor")))
        return rows.where(left).select(*table.columns)

    def step(self, table: DataFrame, rows: int) -> bool:
        """Take up to ``rows`` rows of each unfinished part; False if all parts are done."""
        steps, old = self._steps(), self.state()
        number = steps[-1] + 1 if steps else 0
        if old is not None and old.where("NOT done").isEmpty() and self.pending(table).isEmpty():
            return False
        place = F.row_number().over(Window.partitionBy(self.part).orderBy(*self.keys))
        taken = self.pending(table).withColumn("_place", place).where(F.col("_place") <= rows).drop("_place")
        taken.write.mode("overwrite").parquet(f"{self.path}/rows/step={number}")
        found = self.spark.read.schema(taken.schema).parquet(f"{self.path}/rows/step={number}")
        ends = found.groupBy(F.col(self.part).alias("part")).agg(F.max(F.struct(*self.keys)).alias("cursor"), (F.count(F.lit(1)) < rows).alias("done"))
        if old is not None:
            gone = old.join(ends.select(F.col("part").alias("_new")), F.col("part").eqNullSafe(F.col("_new")), "left_anti")
            # An unfinished part without a row in this step has no more.
            ends = ends.unionByName(gone.select("part", "cursor", F.lit(True).alias("done")))
        ends.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/state/step={number}")
        return True

    def run(self, table: DataFrame, rows: int) -> None:
        while self.step(table, rows):
            pass


def segment(keys: list[str], n: int) -> Column:
    """The number of a row's segment by the hash of its key."""
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def subtask(ts: str, cutoff: Column) -> Column:
    """``backfill`` up to the cutoff, ``incremental`` after it (C15); a null time belongs to the backfill."""
    return F.when(F.col(ts) > cutoff, "incremental").otherwise("backfill")
