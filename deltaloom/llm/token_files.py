"""Token-id files: canonical Huffman blocks of the ids of documents in ascending id order."""

from __future__ import annotations

import os
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import spaced_chunks
from .common import join_checked, pick, shared_folder, stored, text_or_empty
from .huffman import canonical_codes, code_lengths, decoding_table, pack, unpack

#: Documents of a range, ranges at most, ids after which a block ends, chunks in each of a worker's two tables.
RANGE_ROWS, MAX_RANGES, BLOCK_IDS, MEMORY = 4096, 4096, 1 << 18, 400_000
#: Marks that the byte-level pattern parts from a letter or digit before them, and the longest chunk that is remembered.
MARKS, LONGEST = ".,;:!?", 48
#: Letters from here on go to the library with its own pattern.
LETTERS_END = "\u0370"


class LibraryEncoder:
    """Ids from the tokenizers library; chunks that repeat are encoded once and remembered.

    Special tokens' strings in a text are ordinary text.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.width = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}
        self.code = "H" if self.width == "<u2" else "I"
        # The byte-level alphabet writes a byte that is no printable character as one above it (fixed rule).
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = dict(zip([b for b in range(256) if b not in plain], range(256, 512), strict=False))
        vocabulary = self.library.get_vocab()
        #: Bytes of each token: the byte-level alphabet has one character a byte.
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token)

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of many spaced chunks from a few calls: chunks are cuts, so one long text of them has the same ids."""
        out: list[bytes] = []
        for at in range(0, len(chunks), 4096):
            part = chunks[at : at + 4096]
            text = " " + " ".join(part)
            ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
            ends = np.cumsum([len(chunk.encode()) + 1 for chunk in part])
            stops = np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1
            packed, width = ids.astype(self.width).tobytes(), np.dtype(self.width).itemsize
            stops = (stops * width).tolist()
            out += [packed[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]
        return out

    def _batch(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.width).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, core: str) -> bytes:
        """Ids of a space and Latin letters, one match of the pattern, so the library's merges alone decide."""
        spelled = "\u0120" + core if core.isascii() else "\u0120" + core.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [token.id for token in self.library.model.tokenize(spelled)]).tobytes()

    def _learn(self, new: set[str]) -> dict[str, bytes]:
        """Ids of chunks that are not in the table at hand: from the older one, or of a word and the marks after it, or encoded."""
        found, other, older, known = {}, [], self.older.get, self.known
        if len(self.tails) > 10_000:
            self.tails = {"": b""}
        for chunk in new:
            if (ids := older(chunk)) is None:
                core = chunk.rstrip(MARKS)
                if not core.isalpha() or not (core.isascii() or max(core) < LETTERS_END):
                    other.append(chunk)
                    continue
                if (ids := known.get(core)) is None and (ids := older(core)) is None:
                    ids = self._word(core)
                    if len(core) <= LONGEST:
                        known[core] = ids
                if len(core) < len(chunk):
                    tail = chunk[len(core) :]
                    if tail not in self.tails:
                        self.tails[tail] = self._batch([tail])[0]
                    ids += self.tails[tail]
            found[chunk] = ids
        found.update(zip(other, self._chunks(other), strict=True))
        known.update((k, v) for k, v in found.items() if len(k) <= LONGEST)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [spaced_chunks(text) for text in texts]
        if len(self.known) > MEMORY:
            self.known, self.older = {}, self.known
        get, found, gaps, new = self.known.get, [], [], set()
        for part in parts:
            ids = list(map(get, part)) if part else []
            gap = [i for i, x in enumerate(ids) if x is None and i] if None in ids else []
            new.update([part[i] for i in gap])
            found.append(ids)
            gaps.append(gap)
        learnt = self._learn(new) if new else {}
        for part, ids, gap in zip(parts, found, gaps, strict=True):
            for i in gap:
                ids[i] = learnt[part[i]]
        # The first chunk of a text has no space before it.
        heads = self._batch([text if part is None else part[0] for text, part in zip(texts, parts, strict=True)])
        return [head + b"".join(ids[1:]) for head, ids in zip(heads, found, strict=True)]


_ENCODERS: dict[str, LibraryEncoder] = {}


def _encoder(path: str) -> LibraryEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = LibraryEncoder(path)
    return _ENCODERS[path]


def _slices(texts: list[str], size: int = 1_000_000) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        end, total = at, 0
        while end < len(texts) and (end == at or total + len(texts[end]) <= size):
            total += len(texts[end])
            end += 1
        yield at, end
        at = end


def write_token_files(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> None:
    """Encode whole texts and write their ids, each document ended by ``end_id``, under ``path``.

    ``path/code`` holds (symbol, length) of one canonical code from the counts of all ids;
    ``path/blocks`` holds rows of whole documents in ascending id order: range, block, doc_ids,
    sizes (ids of each), n_ids, run_bytes, lane_bits (unsigned 16-bit: the bits of each run of
    256 ids, so decoding can start at any of them) and the bits. Null text is empty; null ids
    sort first; rows that repeat an id stand side by side, shorter ones first. Parquet is
    the container, so any store that Spark reads and writes will do.

    Texts are tokenized once; what is shuffled to bring ids in order are the coded bits.
    """
    spark = docs.sparkSession
    source = pick(docs, doc_id=id_col, text=text_col).select("doc_id", text_or_empty().alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    ids = source.select("doc_id")
    ranges = max(1, min(MAX_RANGES, -(-ids.count() // RANGE_ROWS)))
    edges = ids.where("doc_id IS NOT NULL").repartitionByRange(ranges, "doc_id").groupBy(F.spark_partition_id().alias("part")).agg(F.min("doc_id").alias("least"))
    bounds = sorted(row.least for row in edges.collect())

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        end = np.array([end_id], encoder.width).tobytes()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            where = [0 if i is None else bisect_right(bounds, i) for i in batch.column("doc_id").to_pylist()]
            for a, b in _slices(texts):
                found = [x + end for x in encoder.encode(texts[a:b])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(where[a:b], pa.int32()), pa.array(found, pa.binary())], ["doc_id", "range", "ids"])

    width = _encoder(vocabulary).width
    tokens = stored(source.mapInArrow(tokenize, f"doc_id {kind}, range int, ids binary"), "ids", compression="zstd", **{"parquet.enable.dictionary": "false"})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), width))
            total = np.pad(total, (0, max(0, len(found) - len(total))))
            total[: len(found)] += found
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["symbol", "n"])

    # One row a symbol: bounded by the vocabulary.
    counted = tokens.select("ids").mapInArrow(count, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((row.symbol for row in counted), default=0) + 1, np.int64)
    for row in counted:
        counts[row.symbol] = row.n
    lengths = code_lengths(counts)
    spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths) if n], "symbol int, length int").coalesce(1).write.parquet(f"{path}/code")
    code = spark.sparkContext.broadcast((canonical_codes(lengths), lengths))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, bits = code.value
        for batch in batches:
            rows, at = batch.column("ids").to_pylist(), 0
            while at < len(rows):
                end, total = at, 0
                while end < len(rows) and total < 2_000_000:
                    total += len(rows[end])
                    end += 1
                sizes = np.array([len(r) for r in rows[at:end]], np.int64) // np.dtype(width).itemsize
                data, run_bytes, lanes = pack(np.frombuffer(b"".join(rows[at:end]), width), sizes, codes, bits)
                cut, lane_cut = np.concatenate([[0], np.cumsum(run_bytes)]), np.concatenate([[0], np.cumsum(-(-sizes // 256))])
                lanes16 = lanes.astype("<u2")
                part = batch.slice(at, end - at)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("range"), pa.array(sizes, pa.int32()), pa.array([lanes16[lane_cut[i] : lane_cut[i + 1]].tobytes() for i in range(end - at)], pa.binary()), pa.array([data[cut[i] : cut[i + 1]] for i in range(end - at)], pa.binary())],
                    ["doc_id", "range", "size", "lanes", "bits"],
                )
                at = end

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now, block, total = None, 0, 0

        def closed() -> pa.RecordBatch:
            cols = list(zip(*held, strict=True))
            return pa.RecordBatch.from_pydict(
                {"range": [now], "block": [block], "doc_ids": [list(cols[0])], "sizes": [list(cols[2])], "n_ids": [total], "run_bytes": [[len(b) for b in cols[4]]], "lane_bits": [b"".join(cols[3])], "bits": [b"".join(cols[4])]}, schema=layout
            )

        for batch in batches:
            layout = pa.schema([("range", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(batch.schema.field("doc_id").type)), ("sizes", pa.list_(pa.int32())), ("n_ids", pa.int64()), ("run_bytes", pa.list_(pa.int32())), ("lane_bits", pa.binary()), ("bits", pa.binary())])
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and (row[1] != now or total >= BLOCK_IDS):
                    yield closed()
                    block, held, total = (block + 1 if row[1] == now else 0), [], 0
                now = row[1]
                held.append(row)
                total += row[2]
        if held:
            yield closed()

    coded = tokens.mapInArrow(encode, f"doc_id {kind}, range int, size int, lanes binary, bits binary")
    coded = coded.repartition("range").sortWithinPartitions("range", "doc_id", "size", "bits")
    blocks = coded.mapInArrow(gather, f"range int, block int, doc_ids array<{kind}>, sizes array<int>, n_ids long, run_bytes array<int>, lane_bits binary, bits binary")
    blocks.write.options(compression="uncompressed", **{"parquet.enable.dictionary": "false"}).parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of token files: doc_id, start (ids of all documents before), ids (binary, little-endian unsigned 32-bit)."""
    blocks = spark.read.parquet(f"{path}/blocks")
    rows = spark.read.parquet(f"{path}/code").collect()
    lengths = np.zeros(max((r.symbol for r in rows), default=0) + 1, np.uint8)
    for r in rows:
        lengths[r.symbol] = r.length
    table = spark.sparkContext.broadcast(decoding_table(lengths))
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                sizes = np.array(row.column("sizes")[0].as_py(), np.int64)
                lanes = np.frombuffer(row.column("lane_bits")[0].as_py(), "<u2").astype(np.int64)
                ids = unpack(row.column("bits")[0].as_py(), sizes, np.array(row.column("run_bytes")[0].as_py(), np.int64), lanes, table.value).astype("<u4")
                ends = np.cumsum(sizes)
                start = ends - sizes + row.column("before")[0].as_py()
                each = [ids[a:b].tobytes() for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([row.column("doc_ids").flatten(), pa.array(start, pa.int64()), pa.array(each, pa.binary())], ["doc_id", "start", "ids"])

    # Ids before each block: inside its range, and before the range (ranges are few).
    inside = Window.partitionBy("range").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.select("range", "block", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("ahead"))
    ranges = blocks.groupBy("range").agg(F.sum("n_ids").alias("n"))
    ranges = ranges.select("range", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    places = stored(sizes.join(F.broadcast(ranges), "range").select("range", "block", (F.col("ahead") + F.col("earlier")).alias("before")), "block-places")
    placed = join_checked(blocks, places, ["range", "block"])
    return placed.select("before", "doc_ids", "sizes", "run_bytes", "lane_bits", "bits").mapInArrow(decode, f"doc_id {kind}, start long, ids binary")


def token_file_digests(docs: DataFrame, vocabulary: str, path: str | None = None) -> DataFrame:
    """Write token files, read them back: doc_id, start, n_tokens, ids_crc32."""
    path = path or shared_folder(docs.sparkSession, "token-files")
    write_token_files(docs, path, vocabulary)
    found = read_token_files(docs.sparkSession, path)
    return found.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))

