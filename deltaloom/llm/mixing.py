"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, join_checked, pick, stored, text_or_empty

#: Slices of each size class of a source, so that a hot source is ranked by many tasks.
SALTS = 32


def _unit(col: Column, seed: int) -> Column:
    """A number in [0, 1) drawn from a value and a seed; null is a value of its own."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), col.cast("string")), F.lit("n")))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Targets of sources: (source, source_size) to (source, source_size, target).

    Weights repeat over the sources by code point, null last. The sum of targets is ``share``
    times all sizes, no target is above ``cap`` times its source's size, and what a capped source
    leaves goes to the others by weight. Sorted by cap / weight the capped sources
    come first, so one cumulative sum finds the common level. One row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    place = (F.row_number().over(order) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), place + 1)
    ranked = sizes.withColumn("weight", w).withColumn("ratio", F.col("source_size") * F.lit(float(cap)) / F.col("weight"))
    up = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    after = up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(float(cap))
    leveled = ranked.withColumn("level", left / F.sum("weight").over(after))
    # From the first source that its cap doesn't bind on, levels fall: the first is the greatest.
    level = F.max(F.when(F.col("ratio") >= F.col("level"), F.col("level"))).over(everything)
    most = F.col("source_size") * F.lit(float(cap))
    return leveled.select("source", "source_size", F.coalesce(F.least(most, level * F.col("weight")), most).alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 7) -> DataFrame:
    """How often each document is taken so that sources meet their target sizes in words.

    Returns one row per input row: doc_id, row (hash of the text), source, size, source_size, target, copies, taken
    (copies x size). Every document of a source has the same expected copies, target /
    source_size; documents stand in a fixed order (size class, hash slice, size, id), the
    prefix sum of expected copies gets one offset per source, and a document is emitted
    once per integer crossed. As sizes rise along that order, the words taken follow the
    target closely. Reruns agree. Null text has size 0; null source is a source; rows that
    repeat an id are drawn one by one; a source of size 0 has target 0.

    Ranks come from counts per (source, size class, slice), so no task holds a whole source.
    """
    words = F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")
    sized = stored(pick(docs, doc_id=id_col, text=text_col, source=source_col).select("doc_id", "source", F.xxhash64(text_or_empty()).alias("row"), words.alias("size")), "sizes")
    sized = sized.withColumn("klass", F.floor(F.sqrt("size"))).withColumn("slice", F.floor(_unit(F.col("doc_id"), seed) * SALTS))
    counts = sized.groupBy("source", "klass", "slice").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("words"))
    targets = source_targets(counts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, cap)
    before = Window.partitionBy("source").orderBy("klass", "slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("source", "klass", "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))

    place = Window.partitionBy("source", "klass", "slice").orderBy("size", F.col("doc_id").isNull(), "doc_id", "row")
    ranked = sized.withColumn("place", F.row_number().over(place) - 1).alias("d")
    joined = ranked.join(starts.alias("s"), F.expr("d.source <=> s.source AND d.klass = s.klass AND d.slice = s.slice")).drop(F.col("s.source"), F.col("s.klass"), F.col("s.slice"))
    joined = joined.alias("d").join(targets.alias("t"), F.expr("d.source <=> t.source")).drop(F.col("t.source"))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    i, offset = F.col("start") + F.col("place"), _unit(F.col("source"), seed)
    copies = (F.floor((i + 1) * each + offset) - F.floor(i * each + offset)).cast("long")
    return joined.select("doc_id", "row", "source", "size", "source_size", "target", copies.alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 7) -> DataFrame:
    """The mix itself: each document's row as often as it is taken, with all its columns.

    Rows that repeat an id are told apart by their text; of equal rows each is drawn by itself
    and the copies are the sum.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text, doc_id = F.col(f"c{names.index(text_col)}"), F.col(f"c{names.index(id_col)}")
    plain = plain.withColumn("_id", doc_id).withColumn("_row", F.xxhash64(F.coalesce(text, F.lit(""))))
    mixed = mix_sources(docs, id_col, text_col, source_col, weights, share, cap, seed)
    # One number of copies for each (id, text); equal rows share their sum evenly.
    copies = mixed.groupBy("doc_id", "row").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0")
    copies = stored(copies.select(F.col("doc_id").alias("_doc"), F.col("row").alias("_own"), "copies", "rows"), "copies")
    joined = join_checked(plain, copies, F.expr("_id <=> _doc AND _row = _own"))
    single = joined.where("rows = 1").withColumn("_times", F.col("copies"))
    several = joined.where("rows > 1").withColumn("_place", F.row_number().over(Window.partitionBy("_doc", "_own").orderBy("_row")) - 1)
    several = several.withColumn("_times", F.floor((F.col("_place") + 1) * F.col("copies") / F.col("rows")) - F.floor(F.col("_place") * F.col("copies") / F.col("rows"))).drop("_place")
    taken = single.unionByName(several).where("_times > 0")
    taken = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
    return taken.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)
