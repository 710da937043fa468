"""Substring deduplication by a relative Lempel-Ziv parse over words.

Every text is factored against a reference, which is the first place of each window of words in the
corpus; the reference's index is dealt into blocks by hash, so a text is matched with all blocks in
one join, and no text meets a block that holds none of its windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, discard, join_checked, pick, stored
from .words import mixed, run_hashes, text_slices, word_hashes, word_spans

#: Words of a window that must repeat, and of the seeds that address the reference index.
WINDOW, SEED = 35, 15


def _words(column: pa.StringArray) -> Iterator[tuple]:
    """(first row, end row, data, starts, ends, counts, hashes) of slices of texts."""
    for row, end, data, offsets in text_slices(column):
        starts, ends, counts = word_spans(data, offsets)
        yield row, end, data, starts, ends, counts, word_hashes(data, starts, ends)


def _seed_places(hashes: np.ndarray, counts: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each window of each text: its text, its start, and the place and hash of its seed.

    The seed of a window is its run of ``seed`` words with the least hash (leftmost among equals),
    so equal windows have the same seed at the same offset.
    """
    seeds, runs = run_hashes(hashes, counts, seed, short=False)
    span = window - seed + 1
    windows = np.maximum(counts - window + 1, 0)
    text = np.repeat(np.arange(len(counts)), windows)
    start = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
    if not len(text):
        return text, start, start, np.zeros(0, np.uint64)
    at = start + (np.cumsum(runs) - runs)[text]
    best, offset = seeds[at].copy(), np.zeros(len(at), np.int64)
    for j in range(1, span):
        other = seeds[at + j]
        less = other < best
        best[less] = other[less]
        offset[less] = j
    return text, start, start + offset, best


#: Rows of a single long that a join may broadcast.
LONG_ROWS = 2_000_000


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    texts = pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.select("doc_id", F.xxhash64("text").alias("row"), F.unhex(F.sha2("text", 256)).alias("digest"), "text")


def copied_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts that occur more than once: (copied, first), the digest and the first (id, hash) that has it."""
    places = _texts(docs, id_col, text_col).select("digest", F.struct("doc_id", "row").alias("place"))
    counted = places.groupBy("digest").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    return stored(counted.where("n > 1").select(F.col("digest").alias("copied"), "first"), "copied-texts")


def repeated_factors(docs: DataFrame, copies: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """The parse of texts of which no copy exists: (_doc, _row, factors).

    The reference holds each repeated window once, at one place. A factor (start, end, digest) is
    the longest run of words from ``start`` on whose windows have places that follow one another
    there, at least ``window`` words. ``digest`` is the SHA-256 of the reference's words, for the
    caller to compare with the text's own.

    Index: the reference is every text, dealt by seed hash into blocks (the shuffle's partitions);
    a seed entry is a run of ``seed`` words that some window chose as its least. A text meets
    every block that could hold one of its windows: its seeds are looked up in all of
    them by the join on the seed. Only windows whose seed occurs twice can repeat. Their
    own 128-bit hashes address the reference: the first place of each, or the last for the first
    itself. Of a group of copies only the first text is indexed: all its windows are repeated
    anyway, and other texts still meet them.

    Parse: a factor grows while the next word's window has the next place of the same reference
    text. Where it ends, the windows across its boundary are looked up like all others, and the
    one that reaches furthest begins the next factor, so a word is in some factor exactly if
    it is in a repeated window.

    Seeds and windows are counted with partial sums, so a passage in a third of all
    texts is one row per task; the joins back are plain ones that adaptive execution splits.
    """
    texts = join_checked(_texts(docs, id_col, text_col), copies, F.expr("digest = copied"), "left")
    texts = texts.where("copied IS NULL OR struct(doc_id, row) <=> first").select("doc_id", "row", F.col("copied").isNotNull().alias("twin"), "text")
    kind = texts.schema["doc_id"].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, _, _, _, counts, hashes in _words(batch.column("text")):
                text, _, place, best = _seed_places(hashes, counts, window, seed)
                new = np.ones(len(text), bool)
                new[1:] = (text[1:] != text[:-1]) | (place[1:] != place[:-1])
                doc_id, own = (batch.column(c).slice(row, end - row).take(pa.array(text[new])) for c in ("doc_id", "row"))
                yield pa.RecordBatch.from_arrays([doc_id, own, pa.array(best[new].view(np.int64)), pa.array(place[new], pa.int32())], ["doc_id", "row", "seed", "place"])

    entries = stored(texts.mapInArrow(index, f"doc_id {kind}, row long, seed long, place int"), "seeds")
    shared = stored(entries.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("seed"), "shared-seeds")
    found = join_checked(entries, shared, "seed", rows=LONG_ROWS).groupBy("doc_id", "row").agg(F.collect_set("place").alias("places"))
    found = stored(found.select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row"), "places").withColumn("id", F.monotonically_increasing_id()), "candidates")
    discard(entries)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("places").to_pylist()
            for row, end, _, _, _, counts, hashes in _words(batch.column("text")):
                text, start, place, _ = _seed_places(hashes, counts, window, seed)
                width = int(counts.max(initial=0)) + 1
                known = np.concatenate([np.asarray(p, np.int64) + i * width for i, p in enumerate(places[row:end])] or [np.zeros(0, np.int64)])
                hit = np.isin(text * width + place, known)
                text, start = text[hit], start[hit]
                at = start + (np.cumsum(counts) - counts)[text]
                total, check = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
                if len(at):
                    second = mixed(hashes ^ np.uint64(0xD1B54A32D192ED03))
                    for j in range(window):
                        total = mixed(total * np.uint64(0x9FB21C651E98DF25) + hashes[at + j])
                        check = check * np.uint64(0xA0761D6478BD642F) + second[at + j]
                own, twin = (batch.column(c).slice(row, end - row).take(pa.array(text)) for c in ("id", "twin"))
                yield pa.RecordBatch.from_arrays([own, twin, pa.array(total.view(np.int64)), pa.array(check.view(np.int64)), pa.array(start, pa.int32())], ["id", "twin", "window", "check", "start"])

    near = join_checked(texts, found, F.expr("doc_id <=> _doc AND row = _row"), rows=100_000).select("id", "twin", "text", "places")
    windows = stored(near.mapInArrow(look_up, "id long, twin boolean, window long, check long, start int"), "windows")
    repeated = stored(windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window"), "repeated-windows")
    # Both sides grow with the corpus: shuffles at every size.
    shared = stored(windows.join(repeated, "window"), "shared-windows")
    discard(windows)
    counted = shared.groupBy("window", "check").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "start")).alias("first"), F.max(F.struct("id", "start")).alias("last"))
    reference = stored(counted.where("n > 1").drop("n"), "reference")
    at = F.when(F.col("first") == F.struct("id", "start"), F.col("last")).otherwise(F.col("first"))
    hits = shared.where("NOT twin").join(reference, ["window", "check"]).select("id", F.struct("start", at.alias("at")).alias("hit"))
    hits = hits.groupBy("id").agg(F.sort_array(F.collect_list("hit")).alias("hits"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, flat = batch.column("hits"), batch.column("hits").flatten()
            text = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            start, ref, place = flat.field("start").to_numpy(), flat.field("at").field("id").to_numpy(), flat.field("at").field("start").to_numpy()
            new = np.ones(len(start), bool)
            new[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1] + 1) | (ref[1:] != ref[:-1]) | (place[1:] != place[:-1] + 1)
            first = np.flatnonzero(new)
            end = start[np.append(first[1:], len(start))[: len(first)] - 1] + window
            chosen = first[_greedy(text[first], start[first], end)]
            last = dict(zip(first.tolist(), end.tolist(), strict=True))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(text[chosen])), pa.array(start[chosen]), pa.array([last[k] for k in chosen.tolist()], pa.int32()), pa.array(ref[chosen]), pa.array(place[chosen])], ["id", "start", "end", "ref", "from"])

    parsed = stored(hits.mapInArrow(parse, "id long, start int, end int, ref long, from int"), "parse")
    discard(shared)

    spans = parsed.groupBy("ref").agg(F.collect_set(F.struct("from", (F.col("end") - F.col("start")).alias("size"))).alias("spans"))
    wanted = stored(spans.join(found.drop("places"), F.expr("ref = id")).select("ref", F.col("_doc"), F.col("_row"), "spans"), "reference-spans")
    sources = join_checked(texts, wanted, F.expr("doc_id <=> _doc AND row = _row"), rows=100_000).select("ref", "text", "spans")

    def read_reference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs, wanted = batch.column("ref").to_pylist(), batch.column("spans").to_pylist()
            for row, end, data, starts, ends, counts, _ in _words_only(batch.column("text")):
                raw, first, out = data.tobytes(), np.cumsum(counts) - counts, []
                for i in range(end - row):
                    a, b = (x[first[i] : first[i] + counts[i]] for x in (starts, ends))
                    out += [(refs[row + i], f["from"], f["size"], _span_digest(raw, a, b, f["from"], f["from"] + f["size"])) for f in wanted[row + i]]
                columns = list(zip(*out, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], ["ref", "from", "size", "digest"])

    digests = stored(sources.mapInArrow(read_reference, "ref long, from int, size int, digest binary"), "reference-words")
    checked = join_checked(parsed.withColumn("size", F.expr("end - start")), digests, ["ref", "from", "size"])
    factors = checked.groupBy("id").agg(F.collect_list(F.struct("start", "end", "digest")).alias("factors"))
    return stored(factors.join(found.drop("places"), "id").select("_doc", "_row", "factors"), "factors")


def _greedy(texts: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of the factors that a greedy parse takes: of those that begin no later than the last one ends, the one that reaches furthest.

    Starts and ends both rise inside a text; what the taken ones cover is what all cover.
    """
    chosen, now, reach, held = [], -1, -1, None
    for k, (text, start, end) in enumerate(zip(texts.tolist(), starts.tolist(), ends.tolist(), strict=True)):
        if held is not None and (text != now or start > reach):
            chosen.append(held[0])
            reach, held = held[1], None
        if text != now or start > reach:
            chosen.append(k)
            now, reach = text, end
        else:
            held = (k, end)
    return np.array(chosen if held is None else [*chosen, held[0]], np.int64)


def _span_digest(raw: bytes, starts: np.ndarray, ends: np.ndarray, a: int, b: int) -> bytes:
    """SHA-256 of the words from a to b, joined by one space."""
    return sha256(b" ".join([raw[x:y] for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)])).digest()


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Texts without the words of repeated windows.

    A window is ``window`` consecutive words; every word of a window whose words also start
    anywhere else, in the same text too, is removed, whatever else is removed. Returns one row
    per input row: doc_id, n_words, n_removed, kept (the words left, joined by one space).
    Each factor is compared with its reference's words by SHA-256; should two hashes of
    windows ever be equal by chance, the job fails rather than remove unique words.
    Null text has no words; a text shorter than a window keeps all. Rows that repeat an id
    count as texts of their own. Null ids and extra columns are no matter.
    """
    copies = copied_texts(docs, id_col, text_col)
    spans = repeated_factors(docs, copies, id_col, text_col, window, seed)
    texts = _texts(docs, id_col, text_col)
    kind = texts.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, twins = batch.column("factors").to_pylist(), batch.column("twin").to_pylist()
            for row, end, data, starts, ends, counts, _ in _words_only(batch.column("text")):
                raw, kept, removed, first = data.tobytes(), [], [], np.cumsum(counts) - counts
                for i in range(end - row):
                    n = int(counts[i])
                    keep = np.full(n, not twins[row + i] or n < window)
                    for f in found[row + i] or []:
                        own = _span_digest(raw, starts[first[i] : first[i] + n], ends[first[i] : first[i] + n], f["start"], f["end"])
                        if own != f["digest"]:
                            raise ValueError("words with equal hashes differ: a factor is not its reference's text")
                        keep[f["start"] : f["end"]] = False
                    at = np.flatnonzero(keep) + first[i]
                    kept.append(b" ".join([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]).decode())
                    removed.append(int(counts[i]) - len(at))
                part = batch.slice(row, end - row)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    marked = join_checked(texts, copies.select("copied"), F.expr("digest = copied"), "left").withColumn("twin", F.col("copied").isNotNull())
    # The bound is on factors, not on rows: a text may have many.
    few = (spans.agg(F.sum(F.size("factors"))).first()[0] or 0) <= BROADCAST_ROWS
    joined = marked.join(F.broadcast(spans) if few else spans, F.expr("doc_id <=> _doc AND row = _row"), "left").select("doc_id", "text", "twin", "factors")
    return joined.mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept string")


def _words_only(column: pa.StringArray) -> Iterator[tuple]:
    for row, end, data, offsets in text_slices(column):
        starts, ends, counts = word_spans(data, offsets)
        yield row, end, data, starts, ends, counts, None


def substring_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed and the digest of the words left; cases as in ``substring_dedup``."""
    kept = substring_dedup(docs, id_col, text_col, window)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

