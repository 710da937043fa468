"""Joins of batches with targets, merges, and versioned tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Key types whose bounds let a target skip files.
BOUNDED = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.StringType, T.DateType, T.DecimalType, T.DoubleType, T.FloatType)


def load_existing(target: DataFrame, keys: DataFrame, on: list[str], bounds: dict[str, tuple] | None = None) -> DataFrame:
    """Target rows whose key is in the batch, null keys too (J1); ``bounds`` from merge_bounds prune the scan first."""
    wanted = keys.select(*[F.col(k).alias(f"_k_{k}") for k in on])
    return within_bounds(target, bounds or {}).join(wanted, same_keys(on), "left_semi")


def same_keys(keys: list[str]) -> Column:
    """Equality of ``key`` and ``_k_key`` where null is a key like any other."""
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_k_{k}`")) for k in keys])


def uncast(name: str, kind: T.DataType) -> Column:
    """A column as the JSON value that it came from (J2): dates and times as text, binary as base64."""
    c = F.col(f"`{name}`")
    if isinstance(kind, T.TimestampType):
        return F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    if isinstance(kind, T.BinaryType):
        return F.base64(c)
    if isinstance(kind, (T.DateType, T.DecimalType)):
        return c.cast("string")
    return c


def load_reconstruct(target: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Documents of existing keys rebuilt from their columns, null fields left out."""
    found = load_existing(target, keys, on)
    return found.select(*on, F.to_json(F.struct(*[uncast(f.name, f.dataType).alias(f.name) for f in target.schema.fields])).alias("document"))


def merge_bounds(batch: DataFrame, keys: list[str]) -> dict[str, tuple]:
    """Least and greatest value of each key column of a batch without null keys (J3); one row comes to the driver."""
    useful = [f.name for f in batch.schema.fields if f.name in keys and isinstance(f.dataType, BOUNDED)]
    if not useful:
        return {}
    row = batch.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in useful], *[F.min(c).alias(f"lo_{c}") for c in useful], *[F.max(c).alias(f"hi_{c}") for c in useful]).first()
    return {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in useful if row[f"lo_{c}"] is not None and not row[f"nulls_{c}"]}


def within_bounds(target: DataFrame, bounds: dict[str, tuple]) -> DataFrame:
    """Target rows inside the bounds: literal ranges reach the Parquet scan."""
    return reduce(lambda df, b: df.where(F.col(b[0]).between(F.lit(b[1][0]), F.lit(b[1][1]))), bounds.items(), target)


def combine_bounds(bounds: DataFrame) -> DataFrame:
    """Bounds of several batches united; a column keeps them only where every batch has them."""
    per = bounds.groupBy("column").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.every(F.col("lo").isNotNull() & F.col("hi").isNotNull()).alias("_all"))
    return per.select("column", F.when(F.col("_all"), F.col("lo")).alias("lo"), F.when(F.col("_all"), F.col("hi")).alias("hi"))


def merge_into(target: DataFrame, batch: DataFrame, keys: list[str], deleted: Column | None = None, soft: bool = False) -> DataFrame:
    """The target after a batch of one row a key.

    Matched and deleted: gone (kept as an update with ``soft``, J9); matched: replaced; not
    matched and not deleted: inserted. Delete rows of absent keys are dropped (J8). Null is a key
    like any other, as in the reduction.
    """
    flag = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    columns = target.columns
    new = batch.select(*[F.col(f"`{k}`").alias(f"_k_{k}") for k in keys], F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_new"), flag.alias("_deleted"))
    old = target.select(*keys, F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_old"))
    both = old.join(new, same_keys(keys), "full_outer")
    if soft:
        kept = both.where(~(F.col("_old").isNull() & F.coalesce("_deleted", F.lit(False))))
    else:
        kept = both.where(~F.coalesce("_deleted", F.lit(False)))
    row = F.when(F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col("_old"))
    return kept.select(row.alias("_row")).select("_row.*")


def is_insert_only(target: DataFrame, batch: DataFrame, keys: list[str]) -> bool:
    """Whether no key of the batch exists, so an append can stand for the merge."""
    return load_existing(target, batch, keys, merge_bounds(batch, keys)).limit(1).isEmpty()


def delete_by_key(target: DataFrame, deletes: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is not deleted."""
    return target.join(deletes.select(*[F.col(k).alias(f"_k_{k}") for k in keys]), same_keys(keys), "left_anti")


def skip_absent_deletes(batch: DataFrame, target: DataFrame, keys: list[str], deleted: Column) -> DataFrame:
    """The batch without deletes of rows that the target does not hold."""
    known = batch.where(deleted).join(target.select(*[F.col(k).alias(f"_k_{k}") for k in keys]), same_keys(keys), "left_semi")
    return batch.where(~deleted).unionByName(known)


def union_staged(spark, paths: list[str], schema: T.StructType) -> DataFrame:
    """Staged JSON files as one relation with the types of a schema."""
    return spark.read.schema(schema).json(paths)


def versioned_read(df: DataFrame, keys: list[str], version: str, deleted: str) -> DataFrame:
    """The highest version of each key, deleted ones left out (J11); versions are unique in a key."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_r"))
    return last.select(*keys, "_r.*").where(~F.coalesce(F.col(deleted).cast("boolean"), F.lit(False))).select(*df.columns)


def compact_versions(df: DataFrame, keys: list[str], version: str, deleted: str, path: str, partition: str) -> None:
    """Rewrite partitions with their newest versions only (J12); others stay."""
    out = versioned_read(df, keys, version, deleted)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def move_partitions(stage: DataFrame, path: str, partition: str, append: bool = False) -> None:
    """A staged table goes over to the target partition by partition."""
    writer = stage.write.partitionBy(partition)
    (writer.mode("append") if append else writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")).parquet(path)


def join_split_fields(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Column subsets put together on the key, null keys too; where two have a column the later part wins."""
    def both(left: DataFrame, right: DataFrame) -> DataFrame:
        shared = [c for c in right.columns if c in left.columns and c not in keys]
        renamed = right.withColumnsRenamed({c: f"_new_{c}" for c in shared} | {k: f"_k_{k}" for k in keys}).withColumn("_has", F.lit(True))
        joined = left.join(renamed, same_keys(keys), "full_outer")
        for k in keys:
            joined = joined.withColumn(k, F.coalesce(k, f"_k_{k}")).drop(f"_k_{k}")
        for c in shared:
            joined = joined.withColumn(c, F.when(F.col("_has"), F.col(f"_new_{c}")).otherwise(F.col(c)))
        return joined.drop("_has", *[f"_new_{c}" for c in shared])

    return reduce(both, parts)


def attach_children(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, order: list[str], name: str) -> DataFrame:
    """Each parent with the sorted array of its children, empty where it has none."""
    rest = [c for c in children.columns if c != child_key and c not in order]
    kind = children.select(F.array(F.struct(*order, *rest)).alias("x")).schema["x"].dataType
    grouped = children.groupBy(child_key).agg(F.array_sort(F.collect_list(F.struct(*order, *rest))).alias(name))
    joined = parents.join(grouped.withColumnRenamed(child_key, "_parent"), F.col(parent_key) == F.col("_parent"), "left").drop("_parent")
    return joined.withColumn(name, F.coalesce(F.col(name), F.array().cast(kind)))


def associated_documents(df: DataFrame, children: str, carry: list[str]) -> tuple[DataFrame, DataFrame]:
    """A parent fetch as its own documents and those of another binding."""
    return df.drop(children), df.select(*carry, F.explode(children).alias("_c")).select(*carry, "_c.*")


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by a window; ``versioned_read`` is the aggregate form."""
    over = Window.partitionBy(*keys).orderBy(*[F.desc(o) for o in order])
    return df.withColumn("_n", F.row_number().over(over)).where("_n = 1").drop("_n")
