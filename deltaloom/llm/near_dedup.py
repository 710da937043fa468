"""Near-duplicate documents: ProbMinHash signatures, banding, exact verification, components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_checked, pick, small_batches, stored
from .linking import link_buckets
from .words import mixed, run_hashes, text_slices, word_hashes, word_spans

#: Signature: BANDS x ROWS registers. At a similarity of 0.8 a pair shares a band with probability 0.9996.
BANDS, ROWS, WORDS = 20, 5, 5


def _uniform(seeds: np.ndarray) -> np.ndarray:
    return ((mixed(seeds) >> np.uint64(11)).astype(np.float64) + 1.0) / 9007199254740993.0


def prob_minhash(grams: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, registers: int) -> np.ndarray:
    """Signatures (n x registers) of ``n`` weighted sets, given as flat elements with their owners.

    Each element has a Poisson process of arrivals whose rate is its weight; an arrival goes to a
    register drawn uniformly, which keeps the element of its earliest arrival. An element stops
    once its next arrival is later than every register of its set, since no later one can matter.
    Registers of two sets agree with the probability Jaccard similarity of the sets.
    """
    best = np.full(n * registers, np.inf)
    chosen = np.zeros(n * registers, np.uint64)
    time, alive, step = np.zeros(len(grams)), np.arange(len(grams)), 0
    while len(alive):
        seeds = grams[alive] + np.uint64((step * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        time[alive] -= np.log(_uniform(seeds)) / weights[alive]
        now = time[alive]
        slot = owner[alive] * registers + (mixed(seeds ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(registers)).astype(np.int64)
        early = np.flatnonzero(now < best[slot])
        np.minimum.at(best, slot[early], now[early])
        won = early[best[slot[early]] == now[early]]
        chosen[slot[won]] = grams[alive[won]]
        latest = best.reshape(n, registers).max(axis=1)
        alive = alive[now < latest[owner[alive]]]
        step += 1
    return chosen.reshape(n, registers)


def _weighted(grams: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, gram), each with weight 1: links are by sets, and so registers agree with their Jaccard similarity."""
    order = np.lexsort((grams, owner))
    g, o = grams[order], owner[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    return g[at], np.ones(len(at)), o[at]


def _sequences(column: pa.StringArray, words: int) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray]]:
    """Of each slice: first row, digests of the word sequences, shingle hashes and their row in the slice."""
    for row, end, data, offsets in text_slices(column):
        starts, ends, counts = word_spans(data, offsets)
        hashes = word_hashes(data, starts, ends)
        at = np.concatenate([[0], np.cumsum(counts)])
        digests = [hashlib.blake2b(hashes[at[i] : at[i + 1]].tobytes(), digest_size=16).digest() for i in range(end - row)]
        grams, runs = run_hashes(hashes, counts, words, short=True)
        yield row, digests, grams, np.repeat(np.arange(end - row), runs)


def signatures(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int, words: int) -> DataFrame:
    """(doc_id, row, digest, keys) for each row: digest of its word sequence and band keys."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, digests, grams, owner in _sequences(batch.column("text"), words):
                g, w, o = _weighted(grams, owner)
                chosen = prob_minhash(g, w, o, len(digests), bands * rows).reshape(len(digests), bands, rows)
                keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), chosen.shape[:2]).copy()
                for r in range(rows):
                    keys = mixed(keys * np.uint64(0x9FB21C651E98DF25) + chosen[:, :, r])
                some = np.isin(np.arange(len(digests)), owner)
                flat = pa.array(keys[some].reshape(-1).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some * bands)]), pa.int32()), flat)
                part = batch.slice(row, len(digests))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row"), pa.array(digests, pa.binary()), lists], ["doc_id", "row", "digest", "keys"])

    small_batches(docs.sparkSession)
    source = pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"), "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(sign, f"doc_id {kind}, row long, digest binary, keys array<long>")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """Classes of documents that are connected by near-duplicate links.

    Two documents are linked if the Jaccard similarity of their sets of ``words``-word shingles is
    at least ``threshold``; candidates come from ProbMinHash signatures of the distinct shingles,
    each of weight 1, every candidate link is verified on the exact sets. Returns one row per
    input row: doc_id, row (hash of the text), class_id (least id of the class), copies (rows
    with the same word sequence), kept (the row's id is the class id). Texts of fewer
    words are one shingle; null and blank texts have the same empty word sequence and form one
    class. Rows that repeat an id share its fate if their texts are in one class; null
    ids are never a class id beside others. Extra columns are ignored.

    Copies collapse to one row before candidates are sought, so a group of copies costs one
    member; see ``link_buckets`` for groups of near copies.
    """
    signed = stored(signatures(docs, id_col, text_col, bands, rows, words), "signatures")
    distinct = signed.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("keys").alias("keys"))
    distinct = stored(distinct.withColumn("id", F.monotonically_increasing_id()), "distinct-texts")
    texts = pick(docs, doc_id=id_col, text=text_col)

    def grams_of(ids: DataFrame) -> DataFrame:
        def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row, digests, grams, owner in _sequences(batch.column("text"), words):
                    g, _, o = _weighted(grams, owner)
                    part = batch.slice(row, len(digests))
                    at = np.searchsorted(o, np.arange(len(digests) + 1))
                    lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(g.view(np.int64)))
                    same = pa.array([a == b for a, b in zip(digests, part.column("digest").to_pylist(), strict=True)], pa.bool_())
                    yield pa.RecordBatch.from_arrays([part.column("id"), lists], ["id", "grams"]).filter(same)

        wanted = stored(join_checked(distinct.select("id", F.col("first").alias("_first"), "digest"), ids, "id", keys=(["id"], ["id"])), "wanted-texts")
        found = join_checked(texts, wanted, F.expr("doc_id <=> _first"), keys=(["doc_id"], ["_first"])).select("id", "digest", "text")
        return found.mapInArrow(shingle, "id long, grams array<long>").dropDuplicates(["id"])

    labels = link_buckets(distinct.select("id", "keys"), grams_of, threshold)
    grouped = distinct.select("id", "digest", "first", "copies").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    least = grouped.groupBy("label").agg(F.min("first").alias("class_id"))
    classes = stored(grouped.join(least, "label").select("digest", "class_id", "copies"), "classes")
    return signed.select("doc_id", "row", "digest").join(classes, "digest").select("doc_id", "row", "class_id", "copies", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """One document of each class of near duplicates, with all its columns.

    Of rows that repeat both the id and the text of one that stays, one stays.
    """
    found = stored(near_duplicates(docs, id_col, text_col, threshold).select("doc_id", "row", "kept"), "decisions")
    gone = stored(found.where("NOT kept").select(F.col("doc_id").alias("_doc"), F.col("row").alias("_gone")).distinct(), "dropped-documents")
    twice = stored(found.where("kept").groupBy(F.col("doc_id").alias("_doc"), F.col("row").alias("_gone")).count().where("count > 1").drop("count"), "repeated-rows")
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    plain = plain.withColumn("_id", F.col(f"c{names.index(id_col)}")).withColumn("_row", F.xxhash64(F.coalesce(F.col(f"c{names.index(text_col)}"), F.lit(""))))
    same = F.expr("_id <=> _doc AND _row = _gone")
    kept = join_checked(plain, gone, same, "left_anti")
    if not twice.isEmpty():
        kept = join_checked(kept, twice, same, "left_anti").unionByName(join_checked(kept, twice, same, "left_semi").dropDuplicates(["_id", "_row"]))
    return kept.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)
