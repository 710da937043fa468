"""Language identification by cross-parsing entropy against suffix automata."""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_checked, pick, small_batches, stored

#: Bounds of the labelled sample of a language that its automaton is built from, and pieces that stand for a longer text.
SAMPLE_ROWS, SAMPLE_CHARS, PIECES = 64, 24_000, 8
#: Characters of a lane; a longer text is parsed lane by lane, so a phrase ends with its lane.
LANE = 512


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, held_fold: int | None, rows: int, chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Texts of up to ``rows`` labelled rows of every language, ``chars`` characters in all of each.

    Rows are the least by a hash of the id, so the sample does not depend on partitions; of rows
    that repeat an id the least text is taken. At most ``rows`` texts of ``chars`` characters are collected for
    each language: a longer text is represented by evenly spaced pieces, as is each row's equal share
    of the language's ``chars`` (see ``_shared``).
    """
    d = pick(docs, doc_id=id_col, text=text_col, lang=lang_col).where("lang IS NOT NULL AND text IS NOT NULL")
    if held_fold is not None:
        d = d.where(fold_of(F.col("doc_id")) != held_fold)
    size = chars // PIECES
    pieces = F.concat_ws("\n", *[F.expr(f"substring(text, 1 + cast((length(text) - {size}) * {k / (PIECES - 1)!r} as int), {size - 1})") for k in range(PIECES)])
    kept = d.select("lang", F.when(F.length("text") <= chars, F.col("text")).otherwise(pieces).alias("text"), F.xxhash64("doc_id").alias("rank"))
    # The limit of ranks is applied in each partition before the shuffle.
    place = F.dense_rank().over(Window.partitionBy("lang").orderBy("rank"))
    ranks = kept.select("lang", "rank").withColumn("place", place).where(F.col("place") <= rows)
    ranks = ranks.select("lang", "rank").distinct()
    found = kept.join(F.broadcast(ranks), ["lang", "rank"]).groupBy("lang", "rank").agg(F.min("text").alias("text")).orderBy("lang", "rank").collect()
    texts: dict[str, list[str]] = {}
    for row in found:
        texts.setdefault(row.lang, []).append(row.text)
    return {lang: _shared(parts, chars) for lang, parts in texts.items()}


def _shared(parts: list[str], chars: int) -> str:
    """Equal shares of ``chars`` characters from all texts; what short ones leave goes to the longer."""
    left, share = chars, {}
    for k, i in enumerate(sorted(range(len(parts)), key=lambda i: len(parts[i]))):
        share[i] = min(len(parts[i]) + 1, left // (len(parts) - k))
        left -= share[i]
    return "".join("\n" + _spread(part, share[i] - 1) for i, part in enumerate(parts) if share[i] > 0)


def _spread(text: str, chars: int) -> str:
    """``chars`` characters of a text: evenly spaced pieces, a line each."""
    if len(text) <= chars or chars < 2 * PIECES:
        return text[:chars]
    size = chars // PIECES
    starts = [(len(text) - size) * k // (PIECES - 1) for k in range(PIECES)]
    return "\n".join(text[a : a + size - 1] for a in starts)


@dataclass
class Transitions:
    """A sparse table (states x symbols) of next states, -1 where there is none.

    Rows are shifted into one array so that no two used cells meet; a cell names the state it
    belongs to. A look-up is two reads however many symbols there are.
    """

    shift: np.ndarray  # first cell of each state
    cells: np.ndarray  # state << 32 | next state; -1 is unused

    @classmethod
    def of(cls, moves: list[dict[int, int]], symbols: int) -> Transitions:
        used: dict[int, int] = {}
        size = 2 * sum(map(len, moves)) + 64
        shift, rng = np.zeros(len(moves), np.int64), random.Random(7)
        # The states with most moves first, while the array is empty; what finds no place goes to a longer end.
        for state in sorted(range(len(moves)), key=lambda s: (-len(moves[s]), s)):
            out = moves[state]
            places = (int(rng.random() * size) for _ in range(64))
            at = next((p for p in places if all(p + c not in used for c in out)), None)
            if at is None:
                at = size + symbols
                size = at + 1
            shift[state] = at
            used.update((at + c, state << 32 | to) for c, to in out.items())
        cells = np.full(size + symbols, -1, np.int64)
        cells[np.fromiter(used.keys(), np.int64, len(used))] = np.fromiter(used.values(), np.int64, len(used))
        return cls(shift, cells)

    def __len__(self) -> int:
        return len(self.shift)

    def __getitem__(self, at: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        state, symbol = at
        cell = self.cells[self.shift[state] + symbol]
        return np.where(cell >> 32 == state, cell & 0xFFFFFFFF, -1)


@dataclass
class CrossParser:
    """An automaton for each language, and the alphabet they share: all letters of the sample.

    Symbol 0 is anything that is not a letter, the last is a letter that no sample has.
    """

    languages: list[str]
    symbols: np.ndarray  # symbol of each code point
    tables: list[Transitions]
    cost: np.ndarray  # of a phrase of each language, 1 for the longest sample

    @classmethod
    def fit(cls, texts: dict[str, str], chars: int = SAMPLE_CHARS) -> CrossParser:
        languages = sorted(texts)
        share = {lang: _balanced(texts[lang], chars) for lang in languages}
        letters = sorted({c for lang in languages for c in share[lang].lower() if c.isalpha()})
        symbols = _alphabet(letters)
        codes = [_encode(share[lang], symbols) for lang in languages]
        # A phrase names its place in the sample and the symbol that ends it.
        cost = np.array([np.log((len(code) + 1) * (len(letters) + 2)) for code in codes])
        return cls(languages, symbols, [suffix_automaton(code, len(letters) + 2) for code in codes], cost / cost.max(initial=1.0))

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text in each language (n x languages), and letters of each text.

        The parse is greedy: a phrase is the longest match of a language's automaton from where
        the last one ended, or one symbol that its sample lacks. Each LANE of a text is parsed
        on its own. All lanes of all texts step together.
        """
        codes = [_encode(text, self.symbols) for text in texts]
        lengths = np.array([len(c) for c in codes], np.int64)
        letters = np.array([np.count_nonzero(c) for c in codes], np.int64)
        lanes = -(-lengths // LANE)
        owner = np.repeat(np.arange(len(texts)), lanes)
        grid = np.full((len(owner), LANE), -1, np.int32)
        for text, (code, first) in enumerate(zip(codes, np.cumsum(lanes) - lanes, strict=True)):
            grid.reshape(-1)[first * LANE : first * LANE + lengths[text]] = code
        counts = np.zeros((len(self.languages), len(owner)), np.int32)
        width = np.minimum(lengths[owner] - (np.arange(len(owner)) - (np.cumsum(lanes) - lanes)[owner]) * LANE, LANE)
        order = np.argsort(-width, kind="stable")
        grid, sorted_width = np.ascontiguousarray(grid[order].T), width[order]
        live = np.searchsorted(-sorted_width, -np.arange(LANE), "left")
        symbols = int(self.symbols.max()) + 1
        for k, table in enumerate(self.tables):
            first = table[np.zeros(symbols, np.int64), np.arange(symbols)]
            # A symbol that the sample lacks is a phrase of its own: it leads to state 0, where the next one begins.
            first = np.maximum(first, 0)
            state = np.zeros(len(owner), np.int64)
            begun = np.zeros(len(owner), np.int32)
            for step in range(LANE):
                n = int(live[step])
                if not n:
                    break
                c = grid[step, :n]
                moved = table[state[:n], c]
                begun[:n] += (moved < 0) | (state[:n] == 0)
                state[:n] = np.where(moved < 0, first[c], moved)
            counts[k, order] = begun
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        np.add.at(out, owner, counts.T)
        return out, letters

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ``und`` and 0 without letters or learned languages."""
        found, letters = self.phrases(texts)
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        # Least cost of the phrases: a place in a short sample is cheaper to name.
        found = found * self.cost
        best = found.argmin(axis=1)
        least = found[np.arange(len(texts)), best]
        odds = np.exp(-np.minimum(0.5 * (found - least[:, None]), 700.0))
        score = np.where(letters > 0, 1.0 / odds.sum(axis=1), 0.0)
        return [self.languages[k] if n else "und" for k, n in zip(best, letters, strict=True)], score


def _balanced(text: str, chars: int) -> str:
    """The same number of characters for each language: a short sample is used as it is."""
    return text[:chars]


def _alphabet(letters: list[str]) -> np.ndarray:
    """Symbols by code point: letters in order from 1, other letters last, the rest 0."""
    out = np.zeros(0x110000, np.int32)
    known = {c: i + 1 for i, c in enumerate(letters)}
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            out[point] = known.get(low if len(low) == 1 else c, len(letters) + 1)
    return out


def _encode(text: str, symbols: np.ndarray) -> np.ndarray:
    """Symbols of a text; runs of non-letters count once."""
    code = symbols[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not len(code):
        return code
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0)
    return code[keep]


def suffix_automaton(code: np.ndarray, symbols: int) -> Transitions:
    """Transitions of the automaton of all substrings of ``code``."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in code.tolist():
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and c not in moves[at]:
            moves[at][c] = new
            at = link[at]
        if at >= 0:
            to = moves[at][c]
            if length[at] + 1 == length[to]:
                link[new] = to
            else:
                copy = len(moves)
                moves.append(dict(moves[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and moves[at].get(c) == to:
                    moves[at][c] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return Transitions.of(moves, symbols)


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_fold: int | None = 0, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """The language of every whole text: doc_id, row (hash of the text), lang_pred, score.

    Learns from a bounded sample of labelled rows (``rows`` and ``chars`` of ``labelled_sample``; ids whose CRC fold is
    ``held_fold`` are left out) and predicts from the text alone. The score is the
    winner's share of the odds, 0 to 1. Null texts and texts without letters are ``und`` with
    score 0, as is everything when no labelled row exists. One narrow pass; the
    broadcast model grows with the number of languages and the bounded sample of each.
    """
    spark = docs.sparkSession
    small_batches(spark)
    model = spark.sparkContext.broadcast(CrossParser.fit(labelled_sample(docs, id_col, text_col, lang_col, held_fold, rows, chars), chars))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column("text").to_pylist(), 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) < 2_000_000):
                    size += len(texts[end])
                    end += 1
                found, score = model.value.predict(texts[at:end])
                part = batch.slice(at, end - at)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row"), pa.array(found, pa.string()), pa.array(score, pa.float64())], ["doc_id", "row", "lang_pred", "score"])
                at = end

    source = pick(docs, doc_id=id_col, text=text_col).select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(predict, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, row long, lang_pred string, score double")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Documents in a learned language, with all their columns: those that are ``und`` go."""
    found = identify_languages(docs, id_col, text_col, lang_col)
    gone = stored(found.where("lang_pred = 'und'").select(F.col("doc_id").alias("_doc"), F.col("row").alias("_gone")).distinct(), "unidentified")
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    plain = plain.withColumn("_id", F.col(f"c{names.index(id_col)}")).withColumn("_row", F.xxhash64(F.coalesce(F.col(f"c{names.index(text_col)}"), F.lit(""))))
    kept = join_checked(plain, gone, F.expr("_id <=> _doc AND _row = _gone"), "left_anti")
    return kept.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)
