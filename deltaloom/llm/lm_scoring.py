"""Language-model scores of texts: a self-attention model and a word-count base."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .attention import CONTEXT, DISCOUNT, AttentionModel, CorpusCounts
from .bpe import read_ranks
from .common import pick, small_batches, stored
from .language import fold_of
from .words import mixed, text_slices, word_hashes, word_spans

#: Windows of the opening that the weights start from, and how many openings one task of the pass trains on.
TRAIN_WINDOWS, SHARE = 16_384, 8
#: Training ids for each window of the pass: at CONTEXT, as it is, that is every window of every text.
WINDOW_IDS = CONTEXT
#: Positions of a text that move as one row.
PIECE = 128 * CONTEXT
#: Bounds of what is broadcast: successor pairs and words. All others come by a join.
MAX_PAIRS, HEAD_WORDS = 1 << 20, 1 << 18

_TOKENIZERS: dict[str, object] = {}


def _tokenizer(path: str, pattern: str):
    if path not in _TOKENIZERS:
        import tiktoken

        _TOKENIZERS[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
    return _TOKENIZERS[path]


def _token_table(texts: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, row, train, ids): ids of the lower-cased text, unsigned 16-bit, tokenized once."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(path, pattern).encode_ordinary
        for batch in batches:
            ids = [np.array(encode(text.encode().lower().decode()), "<u2").tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), batch.column("train"), pa.array(ids, pa.binary())], ["doc_id", "row", "train", "ids"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return stored(texts.mapInArrow(tokenize, f"doc_id {kind}, row long, train boolean, ids binary"), "lm-ids", compression="zstd", **{"parquet.enable.dictionary": "false"})


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    ids = batch.column("ids").to_pylist()
    return np.frombuffer(b"".join(ids), "<u2").astype(np.int64), np.array([len(x) // 2 for x in ids], np.int64)


def _frequent(counts: DataFrame, rows: int) -> DataFrame:
    """The rows of a stored frame whose ``n`` is above a bound, the least of a fixed scale that leaves up to ``rows``.

    A filter by grades of n, each an eighth of a doubling, so no task holds or sorts what is kept.
    """
    grade = F.floor(F.log2("n") * 8)
    least, left = None, rows
    for g, size in sorted(map(tuple, counts.groupBy(grade.alias("grade")).count().collect()), reverse=True):  # a few hundred rows at most
        if size > left:
            break
        least, left = g, left - size
    return counts.where(F.lit(False) if least is None else grade >= least)


@dataclass
class Successors:
    """All successor counts as a stored frame (pair, n), and what is kept by id."""

    size: int
    pairs: DataFrame
    totals: np.ndarray  # ids that follow each id
    kinds: np.ndarray  # distinct ids that follow each id
    ids: np.ndarray

    def head(self, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """The most frequent pairs, up to ``rows``, in ascending order, and their counts."""
        found = _frequent(self.pairs, rows).toArrow()
        pair, n = found["pair"].to_numpy(), found["n"].to_numpy()
        order = np.argsort(pair)
        return pair[order], n[order]


def _counts(size: int, pair: np.ndarray, n: np.ndarray, totals: np.ndarray, kinds: np.ndarray, ids: np.ndarray) -> CorpusCounts:
    """The counts with some of the pairs at hand; those of all pairs decide what is left to the unigram."""
    return CorpusCounts.of(size, pair // size, pair % size, n, totals, ids, kinds)


def _successors(tokens: DataFrame, size: int, end: int) -> Successors:
    """Counts of ids and successors over all training texts; partial sums in each task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def add(found: np.ndarray) -> None:
            nonlocal keys, n
            new, times = np.unique(found, return_counts=True)
            both, back = np.unique(np.concatenate([keys, new]), return_inverse=True)
            n = np.bincount(back, np.concatenate([n, times]), minlength=len(both)).astype(np.int64)
            keys = both

        for batch in batches:
            ids, sizes = _flat(batch)
            step, at = 256, 0
            ends = np.concatenate([[0], np.cumsum(sizes)])
            while at < len(sizes):
                to = min(len(sizes), at + step)
                part = ids[ends[at] : ends[to]]
                last = np.zeros(len(part) + to - at, bool)
                last[np.cumsum(sizes[at:to] + 1) - 1] = True
                following = np.full(len(last), end, np.int64)
                following[~last] = part
                add(np.concatenate([[end], following[:-1]]) * size + following)
                at = to
            if len(keys) > 4_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["pair", "n"])
                keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["pair", "n"])

    pairs = tokens.where("train").select("ids").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = stored(pairs, "successors")
    marginal = pairs.groupBy(F.floor(F.col("pair") / size).alias("id")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()  # one row an id
    following = pairs.groupBy((F.col("pair") % size).alias("id")).agg(F.sum("n").alias("n")).collect()
    totals, kinds, ids = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    for row in marginal:
        totals[row.id], kinds[row.id] = row.n, row.kinds
    for row in following:
        ids[row.id] = row.n
    return Successors(size, pairs, totals, kinds, ids)


def _pieces(tokens: DataFrame, end: int) -> DataFrame:
    """(key, windows, ids): all training texts in runs of up to PIECE positions, each with the id before it."""
    every = max(1, WINDOW_IDS // CONTEXT)
    width = PIECE if every == 1 else CONTEXT

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, ids = [], [], []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                line = np.concatenate([[end], np.frombuffer(text, "<u2"), [end]]).astype("<u2")
                for number, at in enumerate(range(0, len(line) - 1, max(width, every * CONTEXT))):
                    part = line[at : at + width + 1]
                    keys.append((key + number) % 2**64)
                    sizes.append(-(-(len(part) - 1) // CONTEXT))
                    ids.append(part.tobytes())
            hashed = mixed(np.array(keys, np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(hashed), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())], ["key", "windows", "ids"])

    # Copies of a text under other ids go elsewhere.
    source = tokens.where("train").select(F.xxhash64("doc_id", "row").alias("key"), "ids")
    return stored(source.mapInArrow(cut, "key long, windows long, ids binary"), "lm-pieces", compression="zstd", **{"parquet.enable.dictionary": "false"})


def _window_arrays(pieces: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets and which positions are real, of the windows of pieces."""
    lines = [np.frombuffer(bytes(x), "<u2") for x in pieces]
    sizes = np.array([len(x) - 1 for x in lines], np.int64)
    room = -(-sizes // CONTEXT) * CONTEXT
    first = np.cumsum(room) - room
    at = np.arange(sizes.sum()) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
    out = []
    for values in ([x[:-1] for x in lines], [x[1:] for x in lines]):
        flat = np.full(int(room.sum()), end, np.int64)
        if len(lines):
            flat[at] = np.concatenate(values)
        out.append(flat.reshape(-1, CONTEXT))
    real = np.zeros(int(room.sum()), bool)
    real[at] = True
    return out[0], out[1], real.reshape(-1, CONTEXT)


def _fitted(some: DataFrame, found: Successors, shared, end: int, weights, **training) -> DataFrame:
    """(shard, weights, n): an own model for each shard of pieces (shard, key, ids), over all their windows.

    A task has the broadcast pairs and, by a join, the counts of its shard's other pairs. ``weights`` are those
    to go on from; None starts anew.
    """
    size = found.size

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = shared.value[0]
        for batch in batches:
            lines = [np.frombuffer(x, "<u2").astype(np.int64) for x in batch.column("ids").to_pylist()]
            pairs = np.concatenate([x[:-1] * size + x[1:] for x in lines]) if lines else np.zeros(0, np.int64)
            shards = np.repeat(batch.column("shard").to_numpy(zero_copy_only=False).astype(np.int64), [len(x) - 1 for x in lines])
            order = np.argsort(pairs)
            pairs, shards = pairs[order], shards[order]
            at = np.minimum(np.searchsorted(head, pairs), max(len(head) - 1, 0))
            new = head[at] != pairs if len(head) else np.ones(len(pairs), bool)
            yield pa.RecordBatch.from_arrays([pa.array(shards[new]), pa.array(pairs[new])], ["shard", "pair"])

    def fit(key, one: pd.DataFrame, rare: pd.DataFrame) -> pd.DataFrame:
        if not len(one):
            return pd.DataFrame({"shard": [], "weights": [], "n": []})
        pair, n, totals, kinds, ids = shared.value
        pair, n = np.concatenate([pair, rare["pair"].to_numpy(np.int64)]), np.concatenate([n, rare["n"].to_numpy(np.int64)])
        own = AttentionModel(size, _counts(size, pair, n, totals, kinds, ids))
        if weights is not None:
            own.w = {k: v.copy() for k, v in weights.value.items()}
            own.freeze()
        x, y, real = _window_arrays(one.sort_values(["key", "ids"])["ids"].tolist(), end)
        own.train(x, y, real=real, **training)
        return pd.DataFrame({"shard": [int(key[0])], "weights": [_packed(own.w)], "n": [int(real.sum())]})

    rare = some.select("shard", "ids").mapInArrow(others, "shard long, pair long").distinct().join(found.pairs, "pair").select("shard", "pair", "n")
    return stored(some.groupBy("shard").cogroup(rare.groupBy("shard")).applyInPandas(fit, "shard long, weights binary, n long"), "lm-weights")


def _packed(w: dict[str, np.ndarray]) -> bytes:
    return b"".join(w[k].astype("<f4").tobytes() for k in sorted(w))


def _unpacked(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    sizes = [like[k].size for k in sorted(like)]
    parts = np.split(flat.astype(np.float32), np.cumsum(sizes)[:-1])
    return {k: part.reshape(like[k].shape) for k, part in zip(sorted(like), parts, strict=True)}


def _mean(rows: Iterable[tuple[bytes, int]]) -> tuple[np.ndarray, int]:
    """The mean of packed weights, each counted ``n`` times, and the sum of ``n``; one row at a time."""
    total, weight = np.zeros(1), 0
    for weights, n in rows:
        total, weight = total + np.frombuffer(bytes(weights), "<f4") * float(n), weight + int(n)
    return total / max(weight, 1), weight


def _trained(tokens: DataFrame, found: Successors, shared, end: int, first: int) -> AttentionModel:
    """The model fitted on every window of every training text.

    An opening of about ``first`` windows, whose pieces are least by hash, gives weights to start from. Where there
    are more, tasks of about SHARE * ``first`` windows each, which together hold all of them, go on from those
    weights, and the weights are averaged in two steps, so no machine holds more than one task's windows
    or more weights than the square root of the tasks.
    """
    pieces, size, spark = _pieces(tokens, end), found.size, tokens.sparkSession
    model = AttentionModel(size, _counts(size, *shared.value))
    n_pieces, due = pieces.agg(F.count(F.lit(1)), F.coalesce(F.sum("windows"), F.lit(0))).first()
    some = min(n_pieces, max(1, first * n_pieces // max(due, 1)))
    opening = pieces.orderBy("key", "ids").limit(some).select(F.lit(0).cast("long").alias("shard"), "key", "ids")
    for row in _fitted(opening, found, shared, end, None).collect():
        model.w = _unpacked(np.frombuffer(bytes(row.weights), "<f4"), model.w)
    if n_pieces > some:
        shards = -(-due // (SHARE * first))
        rows = _fitted(pieces.select(F.pmod("key", F.lit(shards)).alias("shard"), "key", "ids"), found, shared, end, spark.sparkContext.broadcast(model.w), epochs=1, batch=512, rate=0.003)

        def mean(key, one: pd.DataFrame) -> pd.DataFrame:
            one = one.sort_values("shard")
            flat, n = _mean(zip(one["weights"], one["n"], strict=True))
            return pd.DataFrame({"part": [int(key[0])], "weights": [flat.astype("<f4").tobytes()], "n": [n]})

        means = stored(rows.groupBy((F.col("shard") % (1 + int(shards**0.5))).alias("part")).applyInPandas(mean, "part long, weights binary, n long"), "lm-means")
        model.w = _unpacked(_mean((r.weights, r.n) for r in means.orderBy("part").toLocalIterator())[0], model.w)
    model.freeze()
    return model


def lm_scores(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", held_fold: int = 1, train_windows: int = TRAIN_WINDOWS, head_pairs: int = MAX_PAIRS) -> DataFrame:
    """Scores of all whole texts by models of the texts outside one fold of ids.

    Returns one row per input row: doc_id, held_out, n_tokens (words and one end), n_known (of
    words seen in training), train_tokens, base_score (log10 probability by smoothed word
    counts) and score (log10 probability of the lower-cased text's subword ids and end by the
    self-attention model). A-Z count as a-z. Null text is empty: its one token is the
    end. Rows that repeat an id and a text are scored alike; a null id is in no fold.

    Word counts, successor counts of subword ids and the weights of the attention layer are learned
    from every training text; the weights start from an opening of ``train_windows`` windows (see
    ``_trained``). Broadcast: the ``head_pairs`` most frequent pairs and HEAD_WORDS words; counts of
    all other pairs and words come by a join, so neither bound changes a score.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    held = F.coalesce(fold_of(F.col("doc_id")) == held_fold, F.lit(False))
    texts = texts.select("doc_id", F.xxhash64("text").alias("row"), (~held).alias("train"), "text")
    kind = texts.schema["doc_id"].dataType.simpleString()

    # The attention model.
    end, size = max(read_ranks(vocabulary).values()) + 1, max(read_ranks(vocabulary).values()) + 2
    tokens = _token_table(texts, vocabulary, pattern)
    found = _successors(tokens, size, end)
    shared = spark.sparkContext.broadcast((*found.head(head_pairs), found.totals, found.kinds, found.ids))
    weights = spark.sparkContext.broadcast(_trained(tokens, found, shared, end, train_windows).w)

    def attend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = AttentionModel.__new__(AttentionModel)
        own.w, own.counts, own.size = weights.value, _counts(size, *shared.value), size
        own.freeze()
        for batch in batches:
            ids, sizes = _flat(batch)
            ends, at = np.concatenate([[0], np.cumsum(sizes)]), 0
            while at < len(sizes):
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + 100_000, "right")) - 1)
                sums, text, pairs, plain, weight = own.score_parts(ids[ends[at] : ends[to]], sizes[at:to], end)
                order = np.argsort(text, kind="stable")
                places = pa.array(np.searchsorted(text[order], np.arange(to - at + 1)), pa.int32())
                known = np.maximum(shared.value[2][pairs // size], 1)
                parts = pa.StructArray.from_arrays([pa.array(x[order]) for x in (pairs, known, plain.astype(np.float64), weight.astype(np.float64))], ["pair", "total", "plain", "weight"])
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row"), pa.array(sums), pa.ListArray.from_arrays(places, parts)], ["doc_id", "row", "known", "rare"])
                at = to

    parts = tokens.select("doc_id", "row", "ids").mapInArrow(attend, f"doc_id {kind}, row long, known double, rare array<struct<pair:long,total:long,plain:double,weight:double>>")
    parts = stored(parts.withColumn("uid", F.monotonically_increasing_id()), "lm-scores")
    # Positions whose pair is not in the broadcast head get its count by a join.
    rare = parts.select("uid", F.explode("rare").alias("r")).select("uid", "r.*").join(found.pairs, "pair", "left")
    prob = F.coalesce((F.col("n") - DISCOUNT) / F.col("total"), F.lit(0.0))
    rare = rare.groupBy("uid").agg(F.sum(F.log10(F.greatest(F.col("plain") + F.col("weight") * prob, F.lit(1e-30)))).alias("rare_sum"))
    scored = parts.join(rare, "uid", "left").select("doc_id", "row", (F.col("known") + F.coalesce("rare_sum", F.lit(0.0))).alias("score"))
    return _base_scores(texts).join(scored.dropDuplicates(["doc_id", "row"]).select(F.col("doc_id").alias("_doc"), F.col("row").alias("_row"), "score"), F.expr("doc_id <=> _doc AND row = _row")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def _base_scores(texts: DataFrame) -> DataFrame:
    """(doc_id, row, held_out, n_tokens, n_known, train_tokens, base_score) by word counts."""
    spark, kind = texts.sparkSession, texts.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [word_hashes(data, *word_spans(data, offsets)[:2], lower=True) for _, _, data, offsets in text_slices(batch.column("text"))]
            words, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

    train = texts.where("train")
    counts = stored(train.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    n_docs = train.count()
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    total, distinct = total + n_docs, distinct + (n_docs > 0)
    top = _frequent(counts, HEAD_WORDS).toArrow().sort_by("word")
    head = spark.sparkContext.broadcast((top["word"].to_numpy(), np.log10(top["n"].to_numpy() + 0.5)))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, logs = head.value
        for batch in batches:
            for row, to, data, offsets in text_slices(batch.column("text")):
                starts, ends, counts = word_spans(data, offsets)
                hashes = word_hashes(data, starts, ends, lower=True).view(np.int64)
                owner = np.repeat(np.arange(to - row), counts)
                at = np.minimum(np.searchsorted(words, hashes), max(len(words) - 1, 0))
                known = words[at] == hashes if len(words) else np.zeros(len(hashes), bool)
                sums = np.bincount(owner[known], logs[at[known]], minlength=to - row).astype(np.float64)
                rare = np.concatenate([[0], np.cumsum(np.bincount(owner[~known], minlength=to - row))])
                part = batch.slice(row, to - row)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row"), part.column("train"), pa.array(counts + 1), pa.array(np.bincount(owner[known], minlength=to - row)), pa.array(sums), pa.ListArray.from_arrays(pa.array(rare, pa.int32()), pa.array(hashes[~known]))],
                    ["doc_id", "row", "train", "n_tokens", "head_known", "head_sum", "rare"],
                )

    found = texts.mapInArrow(look_up, f"doc_id {kind}, row long, train boolean, n_tokens long, head_known long, head_sum double, rare array<long>")
    found = stored(found.withColumn("uid", F.monotonically_increasing_id()), "base-parts")
    rare = found.select("uid", F.explode("rare").alias("word")).join(counts, "word", "left")
    rare = rare.groupBy("uid").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_sum"), F.count("n").alias("rare_known"))
    ends = float(np.log10(n_docs + 0.5))
    norm = float(np.log10(total + 0.5 * (distinct + 1)))
    base = F.col("head_sum") + F.coalesce("rare_sum", F.lit(0.0)) + F.lit(ends) - F.col("n_tokens") * F.lit(norm)
    return found.join(rare, "uid", "left").select(
        "doc_id", "row", (~F.col("train")).alias("held_out"), "n_tokens", (F.col("head_known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(n_docs > 0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"), base.alias("base_score")
    )
