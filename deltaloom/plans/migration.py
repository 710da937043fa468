"""Migrations of partitioned tables that go on where they stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.plans.schema import migrate_columns


class Migration:
    """A partitioned Parquet table rewritten under a new schema, partition by partition.

    ``target`` gets each partition as a whole; ``target/_steps`` logs what is finished: one row with the new
    schema, one for each partition, one at the end. A run begins after the last finished step and writes a
    partition that was cut off anew. A log of another schema is an error. The old table stays as it is,
    and ``read`` gives it until the end is logged. Columns that are required in the new schema must have no null.
    """

    STEPS = "kind string, value string"

    def __init__(self, spark: SparkSession, source: str, target: str, schema: T.StructType, partition: str, drop: list[str] | None = None, rename: dict[str, str] | None = None):
        self.spark, self.source, self.target, self.schema, self.partition = spark, source, target.rstrip("/"), schema, partition
        self.drop, self.rename = drop or [], rename or {}

    def _log(self) -> list[tuple[str, str | None]]:
        try:
            return [(r.kind, r.value) for r in self.spark.read.schema(self.STEPS).json(f"{self.target}/_steps").collect()]
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return []
            raise

    def _finish(self, kind: str, value: str | None) -> None:
        self.spark.createDataFrame([(kind, value)], self.STEPS).coalesce(1).write.mode("append").json(f"{self.target}/_steps")

    def _changed(self, rows: DataFrame) -> DataFrame:
        out = migrate_columns(rows.withColumnsRenamed(self.rename).drop(*self.drop), self.schema)
        required = [f.name for f in self.schema.fields if not f.nullable]
        return out.withColumns({c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"null in required {c}"))).otherwise(F.col(c)) for c in required})

    def finished(self) -> bool:
        return ("end", None) in self._log()

    def run(self, after_step: Callable[[str], None] = lambda step: None, together: int = 16) -> None:
        """Do all steps that are left; ``after_step`` is called after each is logged, and ``together`` partitions are one step."""
        log = self._log()
        plan = self.schema.json()
        if not log:
            self._finish("schema", plan)
            after_step("schema")
        elif ("schema", plan) not in log:
            raise ValueError("another migration of this table was begun")
        table = self.spark.read.parquet(self.source)
        done = {value for kind, value in log if kind == "partition"}
        name = F.col(self.partition).cast("string")
        left = sorted((r.p for r in table.select(name.alias("p")).distinct().collect() if (r.p or "") not in done), key=lambda p: p or "")
        for at in range(0, len(left), together):
            group = left[at : at + together]
            known = [p for p in group if p is not None]
            rows = table.where(name.isin(known) | name.isNull() if None in group else name.isin(known))
            self._changed(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.partition).parquet(f"{self.target}/data")
            for p in group:
                self._finish("partition", p or "")
            after_step(f"partitions to {group[-1]}")
        if ("end", None) not in log:
            self._finish("end", None)
            after_step("end")

    def read(self) -> DataFrame:
        """The new table once the migration is finished, the old one before."""
        return self.spark.read.parquet(f"{self.target}/data") if self.finished() else self.spark.read.parquet(self.source)
