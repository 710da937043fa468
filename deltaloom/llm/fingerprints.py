"""Document fingerprints by one-permutation MinHash (native)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .binning import binned_minima, likeness, packed
from .common import SPACES, pick, stored, text_or_empty

BINS, BITS, WORDS = 128, 8, 5


def word_shingles(df: DataFrame, text: str, out: str, words: int = WORDS) -> DataFrame:
    """Add the hashes of runs of ``words`` words of a text; a shorter text is one run, one without words none."""
    trimmed = F.btrim(F.col(text), F.lit(SPACES))
    hashes = F.transform(F.split(trimmed, r"[\x20\x09-\x0D]+"), lambda w: F.xxhash64(w))
    df = df.withColumn("_words", F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(hashes))
    run = lambda i: F.xxhash64(*[F.get("_words", i + j) for j in range(words)])
    starts = F.sequence(F.lit(0), F.greatest(F.size("_words") - words, F.lit(0)))
    return df.withColumn(out, F.when(F.size("_words") > 0, F.transform(starts, run)).otherwise(F.array().cast("array<bigint>"))).drop("_words")


def fingerprinted(df: DataFrame, text: str, out: str, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Add the packed fingerprint of a text column; a text without words has the empty string.

    Works on any frame with a non-null text column; equal texts have equal fingerprints.
    """
    df = binned_minima(word_shingles(df, text, "_grams"), "_grams", "_minima", bins)
    return df.withColumn(out, F.coalesce(packed("_minima", bits), F.lit(""))).drop("_grams", "_minima")


def successors(ids: DataFrame) -> DataFrame:
    """(id) to (id, next_id) in ascending order, the last one's next is the first; ids are distinct.

    Ids are range-partitioned, each range is a window of its own, and only the first id
    of each range is looked at across ranges.
    """
    ranged = stored(ids.select("id").repartitionByRange("id").withColumn("part", F.spark_partition_id()), "id-ranges")
    edges = ranged.groupBy("part").agg(F.min(F.struct("id")).alias("first"))
    after = F.coalesce(F.lead("first").over(Window.orderBy("part")), F.first("first").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    edges = edges.select("part", after.alias("after"))
    within = Window.partitionBy("part").orderBy("id")
    last = F.row_number().over(Window.partitionBy("part").orderBy(F.col("id").desc())) == 1
    rows = ranged.withColumn("lead", F.lead(F.struct("id")).over(within)).withColumn("last", last)
    return rows.join(F.broadcast(edges), "part").select("id", F.when(F.col("last"), F.col("after.id")).otherwise(F.col("lead.id")).alias("next_id"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Fingerprints of texts and of their edits, and how alike they are.

    The edit of a document replaces its last floor(n_chars / 4) code points by as many first
    ones (or all) of the next document by ascending id; after the last comes the first.
    Returns one row per input row: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. Null text is empty; a single id follows
    itself; of rows that repeat an id the one with the fewest code points (then smallest hash)
    stands for it as the next document; null ids sort first. Extra columns are ignored.

    The text is shuffled once by id: both joins by id use the same exchange.
    """
    texts = pick(docs, doc_id=id_col, text=text_col).select("doc_id", text_or_empty().alias("text"))
    mark: Column = F.struct(F.length("text").alias("n"), F.xxhash64("text").alias("h"))
    marks = stored(texts.groupBy("doc_id").agg(F.min(mark).alias("mark"), F.max(F.length("text")).alias("longest")), "marks")
    chain = successors(marks.select(F.col("doc_id").alias("id")))
    chain = stored(
        chain.alias("c").join(marks.alias("a"), F.expr("c.id <=> a.doc_id")).join(marks.alias("b"), F.expr("c.next_id <=> b.doc_id"))
        .select("c.id", "c.next_id", F.floor(F.col("a.longest") / 4).cast("int").alias("need"), F.col("b.mark.n").alias("next_n"), F.col("b.mark.h").alias("next_h")),
        "chain",
    )
    heads = texts.join(chain, F.expr("doc_id <=> next_id")).where(F.length("text").between(F.col("next_n"), F.col("next_n")) & F.xxhash64("text").between(F.col("next_h"), F.col("next_h")))
    heads = heads.select("id", "next_id", F.expr("substring(text, 1, need)").alias("head")).dropDuplicates(["id"])
    quarter = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.expr("substring(text, 1, n_chars - cut)"), F.expr("substring(head, 1, cut)"))
    rows = texts.join(heads, F.expr("doc_id <=> id")).withColumn("n_chars", F.length("text").cast("int")).withColumn("cut", quarter).withColumn("edited", edited)
    rows = fingerprinted(fingerprinted(rows, "text", "fingerprint", bins, bits), "edited", "edited_fingerprint", bins, bits)
    rows = stored(rows.select("doc_id", "next_id", F.col("n_chars").cast("long").alias("n_chars"), F.xxhash64("text").alias("h"), F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint"), "fingerprints")
    first = Window.partitionBy("doc_id").orderBy("n_chars", "h")
    ahead = rows.withColumn("_place", F.row_number().over(first)).where("_place = 1").select(F.col("doc_id").alias("ahead_id"), F.col("fingerprint").alias("ahead"))
    return rows.join(ahead, F.expr("next_id <=> ahead_id")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), bins, bits).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("ahead"), bins, bits).alias("near_next"),
    )
