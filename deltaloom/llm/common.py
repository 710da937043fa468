"""Helpers that the training-data operators share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as in the character class [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
#: One word, for Java and RE2 patterns.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    The folder is read from ``spark.checkpoint.dir``; where that is unset a temporary one takes
    its place on a local master, and a cluster gets an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = os.path.join(tempfile.gettempdir(), "deltaloom-checkpoints")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Makes Spark delete a query's shuffle files when it ends; else they stay until the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a frame to the shared folder and read it again: cuts lineage and survives lost executors.

    The shuffle files of the write are deleted with its end, so the disk holds those of one write at a time.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    found = spark.read.schema(df.schema).parquet(path)
    found.stored_at = path
    return found


def discard(df: DataFrame) -> None:
    """Delete the files of a frame from ``stored`` that nothing reads any more."""
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of an Arrow batch of whole texts; Spark's 10,000 would be some 20 MB of text, held by both sides of each task.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Make the session's Arrow batches BATCH_ROWS long, unless someone has chosen a size below that.

    Spark reads the setting when a plan runs, so it stays set. Rows and results don't depend on it.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def pick(df: DataFrame, **names: str | None) -> DataFrame:
    """Select columns by exact name under new names; other columns, whatever their names, stay out.

    ``pick(docs, doc_id="id", text="body")`` gives doc_id and text. Names that differ only
    in case from others in the frame are no problem.
    """
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{df.columns.index(old)}").alias(new) for new, old in names.items()])


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; the default of the operators' path parameters."""
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    """The pattern that splits text before the merges of the rank files."""
    import public_tokenizers

    return public_tokenizers.PATTERN


#: Rows of narrow columns that a side may have to be broadcast, about 32 MB as a hash table.
BROADCAST_ROWS = 400_000


#: Bits of a page of a bitmap, bits for each key, and bits of a bitmap at most as a power of two (32 MB).
PAGE, KEY_BITS, MOST_BITS = 1 << 15, 16, 28


def thinned(big: DataFrame, small: DataFrame, ours: list[str], theirs: list[str]) -> DataFrame:
    """The rows of ``big`` whose columns ``ours`` may equal the columns ``theirs`` of a row of a stored frame.

    Told by a broadcast bitmap of hashes, so no row of ``big`` is shuffled. No row that has a partner is left out,
    nulls included; a few without one stay, so an exact join has to follow.
    """
    bits = 1 << max(PAGE.bit_length() - 1, min(MOST_BITS, (KEY_BITS * small.count()).bit_length()))
    place = lambda names: F.xxhash64(*names).bitwiseAND(F.lit(bits - 1))
    page = lambda p: F.shiftright(p, PAGE.bit_length() - 1)
    # Places move, not pages of every task.
    marks = small.select(place(theirs).alias("_p")).select(page(F.col("_p")).alias("_page"), F.col("_p").bitwiseAND(F.lit(PAGE - 1)).alias("_bit"))
    marks = marks.repartition("_page").groupBy("_page").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    at = F.col("_p").bitwiseAND(F.lit(PAGE - 1)).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    found = big.withColumn("_p", place(ours)).join(F.broadcast(marks), page(F.col("_p")) == F.col("_page"))
    return found.where(F.getbit(byte, at.bitwiseAND(F.lit(7))) == 1).select(*big.columns)


def join_checked(big: DataFrame, small: DataFrame, on: Column | str | list[str], how: str = "inner", rows: int = BROADCAST_ROWS, keys: tuple[list[str], list[str]] | None = None) -> DataFrame:
    """Join with a stored frame of narrow columns: broadcast if its counted rows fit, else by shuffle.

    The result is the same either way; only the physical join differs. With ``keys``, the columns of
    both sides that ``on`` compares, rows of ``big`` that have no partner in an inner join are not shuffled
    (see ``thinned``).
    """
    few = small.limit(rows + 1).count() <= rows
    if keys and not few:
        big = thinned(big, small, *keys)
    return big.join(F.broadcast(small) if few else small, on, how)
