"""Source divergence audit: how far the sources of a language differ in their terms, and by which."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_checked, pick, small_batches, stored
from .packing import count_terms, term_spans
from .words import text_slices

#: Documents of a language that must have a term, terms that each source lists, and the scale of shares.
LEAST_DOCUMENTS, TOP, SCALE = 10, 10, 1_000_000_000
#: Cells (terms times sources) of a block whose pairs of sources are compared in one task; at most, 32 MB of longs.
CELLS, MOST_CELLS = 1 << 16, 1 << 22


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group, and documents that have it.

    Terms are runs of ASCII letters and characters beyond ASCII, A-Z as a-z. Null text, lang and source are ''.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column("text")):
                part = batch.slice(row, end - row)
                # Texts are renumbered by group: the rank of their language and source.
                names = pa.StructArray.from_arrays([part.column("lang"), part.column("source")], ["lang", "source"])
                keys = [(x["lang"], x["source"]) for x in names.to_pylist()]
                known = sorted(set(keys))
                number = {k: i for i, k in enumerate(known)}
                group = np.array([number[k] for k in keys], np.int64)
                order = np.argsort(group, kind="stable")
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                lowered, starts, ends, counts = term_spans(data, offsets)
                for terms, groups, n, owners in count_terms(lowered, starts, ends, np.repeat(rank, counts), group[order]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([known[g][0] for g in groups.tolist()], pa.string()), pa.array([known[g][1] for g in groups.tolist()], pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n.astype(np.int64)), pa.array(owners)],
                        ["lang", "source", "term", "n", "docs"],
                    )

    small_batches(docs.sparkSession)
    source = pick(docs, lang=lang_col, source=source_col, text=text_col).select(*[F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in ("lang", "source", "text")])
    mapped = source.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return mapped.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exact; 38 digits hold the product."""
    wide = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    return F.call_function("div", wide, (total + 2 * terms).cast("decimal(20,0)")) + 1


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (counts + 2) / totals) in 64 bits, three digits at a time; exact for totals below 9e15."""
    rest, out = counts + 2, np.zeros(counts.shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // totals
        rest = rest % totals
    return out + 1


def _pair_sums(left: pa.Table, right: pa.Table) -> pa.Table:
    """Divergence of each pair of sources (a < b) over the terms of one block: counts on the left, all sources on the right."""
    right = right.sort_by("number")
    lang, terms = right.column("lang")[0].as_py(), right.column("terms")[0].as_py()
    totals = right.column("total").to_numpy() + 2 * terms
    ids = left.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
    counts = np.zeros((int(ids.max()) + 1 if len(ids) else 0, len(totals)), np.int64)
    counts[ids, left.column("number").to_numpy()] = left.column("n").to_numpy()
    p = shares(counts, totals) if terms else counts
    a, b, sums = [], [], []
    for i in range(len(totals) - 1):
        one, others = p[:, i : i + 1], p[:, i + 1 :]
        a.append(np.full(others.shape[1], i, np.int32))
        b.append(np.arange(i + 1, len(totals), dtype=np.int32))
        sums.append(((one - others) ** 2 // (one + others)).sum(axis=0))
    columns = [np.concatenate(x) if x else np.zeros(0, kind) for x, kind in ((a, np.int32), (b, np.int32), (sums, np.int64))]
    return pa.table([pa.array([lang] * len(columns[0]), pa.string()), *map(pa.array, columns)], ["lang", "a", "b", "value"])


def source_divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """Divergence of a language's sources from each other, and the terms that set each of them apart.

    A language keeps its terms that at least ``least`` of its documents have. In each (lang, source)
    group and in each language a kept term has the smoothed share p of ``_share``; two
    groups differ by f = floor((p - q)^2 / (p + q)) in it. Returns lang, source, part, item, value, rank:
    part 'pair' has each other source of the language with f summed over all kept terms (0 without
    any), part 'term' the first ``top`` kept terms that occur in the group with a larger share than in the
    language. Ranks run from 1 by falling value, then rising item.

    Null texts, languages and sources count as '', so null and '' are one group; repeated rows count
    as often as they stand; a language of one source has no pairs; an empty table gives no rows. Extra columns are
    ignored. Counts are summed before they are shuffled by term, so neither a hot source nor a hot
    term gathers rows; pairs are summed over blocks of terms, each with all sources of the language.
    """
    counts = term_counts(docs, lang_col, source_col, text_col)
    of_term = Window.partitionBy("lang", "term")
    kept = counts.withColumns({"lang_docs": F.sum("docs").over(of_term), "lang_n": F.sum("n").over(of_term)}).where(F.col("lang_docs") >= least)
    kept = stored(kept.select("lang", "source", "term", "n", "lang_n"), "kept-terms")

    named = pick(docs, lang=lang_col, source=source_col).select(*[F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in ("lang", "source")]).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.countDistinct("term").alias("terms"))
    groups = named.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "lang_total", "terms"])
    by_lang = Window.partitionBy("lang")
    groups = groups.withColumns({"number": F.row_number().over(by_lang.orderBy("source")) - 1, "sources": F.count(F.lit(1)).over(by_lang)})
    # A block gives half the square of the number of sources, so it has that many cells if it may.
    cells = F.greatest(F.lit(CELLS), F.least(F.col("sources") * F.col("sources"), F.lit(MOST_CELLS)))
    groups = stored(groups.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("terms") * F.col("sources") / cells)).cast("int")), "groups")

    counted = join_checked(kept, groups, ["lang", "source"])
    p, q = _share(F.col("n"), F.col("total"), F.col("terms")), _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    apart = counted.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))

    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    parts = counted.select("lang", block, "term", "number", "n").groupBy("lang", "block")
    frames = groups.toDF(*[f"{c}_" for c in groups.columns]).select(F.col("lang_").alias("lang"), F.explode(F.sequence(F.lit(0), F.col("blocks_") - 1)).alias("block"), F.col("number_").alias("number"), F.col("total_").alias("total"), F.col("terms_").alias("terms")).groupBy("lang", "block")
    sums = parts.cogroup(frames).applyInArrow(_pair_sums, "lang string, a int, b int, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sums = stored(sums, "pair-sums")
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = groups.select("lang", F.col("number").alias("a"), "source")
    pairs = join_checked(join_checked(both, names, ["lang", "a"]), names.select("lang", F.col("a").alias("b"), F.col("source").alias("item")), ["lang", "b"]).select("lang", "source", "item", "value")

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = [x.withColumn("rank", F.row_number().over(order)) for x in (pairs, apart)]
    shaped = [x.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, x in (("pair", ranked[0]), ("term", ranked[1].where(F.col("rank") <= top)))]
    return shaped[0].unionByName(shaped[1])
