"""Exact deduplication by a log-structured merge index of text digests (native)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, join_checked, pick, shared_folder, stored, text_or_empty

#: Rows of one group that one task verifies against the group's keeper.
VERIFY_ROWS = 4096


class MergeIndex:
    """Sorted runs of (digest, best, rows) on shared storage.

    A memtable is the hash aggregate of one slice of a batch; ``flush`` writes each sorted by
    digest, with a Parquet Bloom filter on the digest, as one run of level 0. ``compact`` merges
    all runs into one of the next level and keeps, for each digest, the smallest ``best`` and
    the summed row count; batches may be flushed and compacted in any order. ``lookup`` joins
    digests with all runs; ``entry`` seeks one digest, for which the scan's equality filter
    consults the Bloom filters and skips row groups.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, memtables: int = 4):
        self.spark, self.path, self.memtables = spark, path or shared_folder(spark, "merge-index"), memtables
        self.runs: list[str] = []
        self.level, self.written = 0, 0

    def _write(self, merged: DataFrame, level: int) -> None:
        path = f"{self.path}/level={level}-run={self.written}"
        self.written += 1
        writer = merged.write.option("parquet.bloom.filter.enabled#digest", "true")
        writer.option("parquet.bloom.filter.expected.ndv#digest", "1000000").option("parquet.bloom.filter.max.bytes", "1048576").parquet(path)
        self.runs.append(path)

    def flush(self, batch: DataFrame) -> None:
        """Add rows (digest, best); each memtable of the batch becomes sorted runs of its own."""
        memtable = F.pmod(F.xxhash64("best"), F.lit(self.memtables)).alias("memtable")
        sums = batch.groupBy(memtable, "digest").agg(F.min("best").alias("best"), F.count(F.lit(1)).alias("rows"))
        self._write(sums.sortWithinPartitions("memtable", "digest"), 0)

    def compact(self) -> None:
        """Merge every run into one of the next level; smallest identifiers win."""
        merged = self.entries().sortWithinPartitions("digest")
        self.runs = []
        self.level += 1
        self._write(merged, self.level)

    def entries(self) -> DataFrame:
        """One row a digest over all runs: (digest, best, rows)."""
        runs = self.spark.read.parquet(*self.runs)
        return runs.groupBy("digest").agg(F.min("best").alias("best"), F.sum("rows").alias("rows"))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The index entry of each row's digest. After ``compact`` each digest has one entry."""
        return keys.join(self.compacted().select("digest", "best", "rows"), "digest")

    def compacted(self) -> DataFrame:
        """The entries; right after ``compact`` they are read as they stand."""
        return self.spark.read.parquet(*self.runs) if len(self.runs) == 1 and self.level else self.entries()

    def entry(self, digest: bytes) -> DataFrame:
        """The entry of one digest, by a pushed-down equality."""
        found = self.spark.read.parquet(*self.runs).where(F.col("digest") == F.lit(digest))
        return found.groupBy("digest").agg(F.min("best").alias("best"), F.sum("rows").alias("rows"))


def _best(n_chars: Column, doc_id: Column) -> Column:
    """Sorts the row that stays first: most code points, then smallest id, null ids last."""
    return F.struct((-n_chars).alias("neg_chars"), doc_id.isNull().alias("no_id"), doc_id.alias("id"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] | None = None, memtables: int = 4) -> DataFrame:
    """Groups of texts that are equal without ASCII white space.

    Returns one row per input row: doc_id, keep_id, group_size, kept, text_sha256. The row with
    the most code points, then the smallest id, stays. Null text counts as empty; all texts
    without any non-space character form one group. Null ids sort last. Rows that repeat
    one id share its decision and each counts in group_size. An empty table gives no
    rows; other columns are ignored.

    ``digest`` (default SHA-256) only addresses the index: every hit's bytes are compared with
    the keeper's, and rows of a digest that stands for several texts are grouped by the
    text itself. Hot groups: partial sums combine before the shuffle, the verifying join
    is salted by group size, and the plain joins are left to adaptive skew handling.
    """
    spark = docs.sparkSession
    digest = digest or (lambda norm: F.unhex(F.sha2(norm, 256)))
    texts = pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.length(text_or_empty()).alias("n_chars"), F.translate(text_or_empty(), SPACES, "").alias("norm"))
    keyed = stored(texts.select("doc_id", digest(F.col("norm")).alias("digest"), F.sha2("norm", 256).alias("text_sha256"), _best(F.col("n_chars"), F.col("doc_id")).alias("own")), "digests")

    index = MergeIndex(spark, memtables=memtables)
    index.flush(keyed.select("digest", F.col("own").alias("best")))
    index.compact()

    # Hits: digests of more than one row. Where these are few enough to be broadcast only their texts move.
    shared = stored(index.compacted().where("rows > 1"), "shared-digests")
    hits = join_checked(texts.select("doc_id", "n_chars", "norm", digest(F.col("norm")).alias("digest")), shared, "digest").withColumn("own", _best(F.col("n_chars"), F.col("doc_id")))
    salts = F.ceil(F.col("rows") / VERIFY_ROWS)
    keepers = hits.where("own = best").select("digest", "rows", "norm").dropDuplicates(["digest", "norm"])
    keepers = keepers.select("digest", F.col("norm").alias("kept_norm"), F.explode(F.sequence(F.lit(0), (salts - 1).cast("int"))).alias("salt"))
    members = hits.select("digest", "norm", "own", F.pmod(F.xxhash64("doc_id"), salts).cast("int").alias("salt"))
    differ = stored(members.join(keepers, ["digest", "salt"]).where("norm <> kept_norm").select("digest").distinct(), "collisions")

    grouped = index.lookup(keyed)
    if not differ.isEmpty():
        # A digest of several texts: its rows are grouped by the text.
        rows = texts.select("n_chars", "norm", "doc_id", digest(F.col("norm")).alias("digest")).join(differ, "digest", "left_semi")
        by_text = rows.groupBy(F.sha2("norm", 256).alias("text_sha256"), "norm").agg(F.min(_best(F.col("n_chars"), F.col("doc_id"))).alias("best"), F.count(F.lit(1)).alias("rows"))
        again = keyed.join(differ, "digest", "left_semi").join(by_text.drop("norm"), "text_sha256")
        grouped = grouped.join(differ, "digest", "left_anti").unionByName(again.select(*grouped.columns))
    return grouped.select(
        F.col("own.id").alias("doc_id"), F.col("best.id").alias("keep_id"), F.col("rows").cast("long").alias("group_size"), F.col("own").eqNullSafe(F.col("best")).alias("kept"), "text_sha256"
    )
