"""Conversation structure repair: least edits that make the roles of each conversation alternate."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, join_checked, pick, small_batches, stored
from .viterbi import DELETE, CHANGE, END, FAR, FOLLOWS, GONE, KEEPS, backward, ending, fixed_up, level, matrix, trace

#: Distinct rows of a chunk, and fix-up passes after which the chunks that still change go by matrices.
CHUNK, PASSES = 4_096, 6
#: Characters of a text that order rows of one turn and role, before its digest does.
HEAD = 16
#: Order of a conversation's rows.
ORDER = ["conv_id", "turn", "role", "head", "digest"]
LEGAL = {"su", "ua", "au"}


def damage(rows: DataFrame) -> DataFrame:
    """The rows with ``copies``, damaged by crc32 of ``conv_id:turn`` modulo 20; null role and text become one space.

    0 drops a row (it stays with 0 copies and no text), 1 empties its text, 2 removes its full stops, exclamation and question
    marks, 3 repeats it, 4 makes its role user.
    """
    named = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(named) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    text = F.when(fault <= 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return rows.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"), text.alias("text"), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))


def _same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    """Equality of a's columns with b's of the same names and a trailing underscore, nulls included."""
    out = F.lit(True)
    for n in names:
        out = out & a[n].eqNullSafe(b[f"{n}_"])
    return out


def faults(rows: DataFrame) -> DataFrame:
    """Distinct rows (ORDER, copies, blank, truncated, repeated): repeated if an earlier turn has the same role and text.

    Only digests of texts are shuffled. Rows equal in all columns become one with their number.
    """
    end = F.rtrim("text", F.lit(SPACES))
    marks = rows.where("copies > 0").select("conv_id", "turn", "role", "head", "digest", "copies", (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    distinct = stored(marks.groupBy(*ORDER, "blank", "truncated").agg(F.sum("copies").alias("copies")), "turns")
    again = distinct.groupBy("conv_id", "role", "digest").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("turn").isNotNull(), "turn"))["turn"].alias("first")).where("n > 1")
    again = stored(again.select(F.col("conv_id").alias("conv_id_"), F.col("role").alias("role_"), F.col("digest").alias("digest_"), "first", F.lit(True).alias("several")), "repeated")
    both = join_checked(distinct, again, _same(distinct, again, "conv_id", "role", "digest"), "left")
    return both.select(*ORDER, "copies", "blank", "truncated", (F.coalesce("several", F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first"))).alias("repeated"))


def _chunk_schema(rows: DataFrame) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return ", ".join(f"{c} {kinds[c]}" for c in ORDER) + ", part int, seq int, codes binary, copies array<long>, blank long, duplicate long, truncated long"


def chunks(marked: DataFrame, size: int) -> DataFrame:
    """Rows in order, ``size`` at most to a chunk, each with the key of its first row; a conversation may go on in the next partition."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, part, seq, none = None, TaskContext.get().partitionId(), 0, object()
        key, codes, copies, counts = none, bytearray(), [], [0, 0, 0]
        done: list[tuple] = []

        def close() -> None:
            nonlocal seq, codes, copies, counts
            if codes:
                done.append((*key, part, seq, bytes(codes), copies, *counts))
                seq, codes, copies, counts = seq + 1, bytearray(), [], [0, 0, 0]

        def flush() -> pa.RecordBatch:
            columns = [pa.array(list(x), f.type) for x, f in zip(zip(*done), schema)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            if schema is None:
                more = [("part", pa.int32()), ("seq", pa.int32()), ("codes", pa.binary()), ("copies", pa.list_(pa.int64())), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64())]
                schema = pa.schema([batch.schema.field(c) for c in ORDER] + [pa.field(*x) for x in more])
            for *own, n, blank, truncated, repeated in zip(*[batch.column(c).to_pylist() for c in [*ORDER, "copies", "blank", "truncated", "repeated"]]):
                if not codes or own[0] != key[0] or len(codes) == size:
                    close()
                    key = own
                if blank or repeated:
                    codes.append(GONE)
                else:
                    codes.append("sua".find(own[2][:1] or "-") & 3 | 4 * truncated)
                copies.append(n)
                counts[0] += n * blank
                counts[1] += 0 if blank else n - (not repeated)
                counts[2] += truncated and not blank and not repeated
            if len(done) >= 1_000:
                yield flush()
        close()
        if done:
            yield flush()

    return marked.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).mapInArrow(cut, _chunk_schema(marked))


def _free(codes: bytes) -> bytes:
    """Codes of the rows that may stay; the others leave states and vectors as they are."""
    return codes.translate(None, bytes([GONE]))


def _mapped(frame: DataFrame, names: list[str], columns: list[str], f, kinds: str) -> DataFrame:
    """``names`` of a frame beside the columns that ``f`` gives for each row of ``columns``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = [f(*x) for x in zip(*[batch.column(c).to_pylist() for c in columns])]
                made = [pa.array(list(x)) for x in zip(*found)]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + made, [*names, *outs])

    outs = [x.split()[0] for x in kinds.split(", ")]
    schema = {x.name: x.dataType.simpleString() for x in frame.schema}
    return frame.mapInArrow(run, ", ".join(f"{c} {schema[c]}" for c in names) + f", {kinds}")


def _product(a: str, b: str) -> Column:
    """Min-plus product of two 4 x 4 matrices of costs."""
    cells = [F.least(*[F.col(a)[4 * i + k] + F.col(b)[4 * k + j] for k in range(4)], F.lit(FAR)) for i in range(4) for j in range(4)]
    return F.array(*cells)


def _scan(frame: DataFrame, forward: bool) -> DataFrame:
    """(conv_id, k, of, m) with m the product of the matrices up to k, or from k on: pairs of spans that double in length."""
    longest, reach = frame.agg(F.max("of")).first()[0], 1
    while reach < longest:
        other = frame.select(F.col("conv_id").alias("conv_id_"), (F.col("k") + (reach if forward else -reach)).alias("k_"), F.col("m").alias("m_"))
        both = frame.join(other, _same(frame, other, "conv_id", "k"), "left")
        found = _product("m_", "m") if forward else _product("m", "m_")
        frame, reach = stored(both.select("conv_id", "k", "of", F.when(F.col("m_").isNull(), F.col("m")).otherwise(found).alias("m")), "spans"), 2 * reach
    return frame


def _vector(v: Column | list[int]) -> Column:
    return F.array(*[F.lit(x).cast("long") for x in v])


def _neighbours(frame: DataFrame, column: str, shift: int) -> DataFrame:
    """The frame with ``column`` of the chunk ``shift`` places on, null where there is none."""
    other = frame.select(F.col("conv_id").alias("conv_id_"), (F.col("k") - shift).alias("k_"), F.col(column).alias("beside"))
    return frame.join(other, _same(frame, other, "conv_id", "k"), "left").drop("conv_id_", "k_")


def cost_vectors(parts: DataFrame, passes: int) -> DataFrame:
    """(conv_id, k, of, codes, after) of the chunks of divided conversations: the levelled vector after each.

    Each chunk starts from the speculative vector of a conversation's end. A fix-up pass gives it the
    vector that the next chunk found, and reruns it until old and new differ only by a constant; passes end once no
    chunk gets another vector. Roles outside s, u and a can carry a difference along any number of
    chunks; what still changes after ``passes`` goes by products of the chunks' cost matrices.
    """
    state = stored(_mapped(parts, ["conv_id", "k", "of", "codes"], ["codes"], lambda codes: (list(END), list(backward(_free(codes), END))), "after array<bigint>, out array<bigint>"), "vectors")

    def again(codes, after, out, beside):
        return beside, list(fixed_up(_free(codes), tuple(beside), tuple(after), tuple(out)))

    for _ in range(passes):
        beside = stored(_neighbours(state, "out", 1).withColumn("beside", F.coalesce("beside", _vector(END))), "beside")
        if beside.where("beside <> after").isEmpty():
            return state
        state = stored(_mapped(beside, ["conv_id", "k", "of", "codes"], ["codes", "after", "out", "beside"], again, "after array<bigint>, out array<bigint>"), "vectors")
    spans = _scan(stored(_mapped(parts, ["conv_id", "k", "of"], ["codes"], lambda codes: (matrix(_free(codes)),), "m array<bigint>"), "matrices"), forward=False)
    out = spans.select("conv_id", "k", F.array(*[F.least(*[F.col("m")[4 * i + j] + END[j] for j in range(4)]) for i in range(4)]).alias("out"))
    out = out.select(F.col("conv_id").alias("conv_id_"), (F.col("k") - 1).alias("k_"), F.transform("out", lambda x: x - F.col("out")[3]).alias("found"))
    return state.join(out, _same(state, out, "conv_id", "k"), "left").select("conv_id", "k", "of", "codes", F.coalesce("found", _vector(END)).alias("after"))


def _starts(vectors: DataFrame) -> DataFrame:
    """(conv_id_, k_, after, start) of the chunks of divided conversations: the state in which least audits enter each."""

    def ends(codes, after):
        free, found = _free(codes), [FAR] * 16
        for s in range(4):
            found[4 * s + trace(free, tuple(after), s)[1]] = 0
        return (found,)

    spans = _scan(stored(_mapped(vectors, ["conv_id", "k", "of"], ["codes", "after"], ends, "m array<bigint>"), "ends"), forward=True)
    state = spans.select(F.col("conv_id").alias("conv_id_"), (F.col("k") + 1).alias("k_"), (F.array_position(F.slice("m", 1, 4), F.lit(0).cast("long")) - 1).cast("int").alias("start"))
    both = vectors.join(state, _same(vectors, state, "conv_id", "k"), "left")
    return both.select(F.col("conv_id").alias("conv_id_"), F.col("k").alias("k_"), "after", F.coalesce("start", F.lit(0)).alias("start"))


def _letters(codes: bytes, copies: list[int], after: list[int], start: int, last: bool) -> tuple[str, int]:
    """The audit of a chunk and its cost."""
    found, state = trace(_free(codes), tuple(after), start)
    rest, out, cost = iter(zip(found, _free(codes))), [], 0
    for code, n in zip(codes, copies):
        if code == GONE:
            out.append("D" * n)
        else:
            letters, own = next(rest)
            out.append(letters + "D" * (n - 1))
            cost += 0 if letters[-1] == "D" else own >> 2
    audit = "".join(out) + (ending(state) if last else "")
    return audit, cost + DELETE * audit.count("D") + CHANGE * (audit.count("R") + audit.count("I"))


def audits(rows: DataFrame, size: int, passes: int) -> DataFrame:
    """One row for each chunk of each conversation: key of its first row (ORDER), audit, cost, blank, duplicate, truncated."""
    found = chunks(faults(rows), size)
    by_conversation = Window.partitionBy("conv_id")
    found = stored(found, "chunks")
    found = stored(found.withColumns({"k": F.row_number().over(by_conversation.orderBy("part", "seq")), "of": F.count(F.lit(1)).over(by_conversation)}), "numbered-chunks")
    whole, divided = found.where("of = 1").withColumns({"after": _vector(END), "start": F.lit(0)}), found.where("of > 1")
    if not divided.isEmpty():
        starts = _starts(cost_vectors(divided, passes))
        whole = whole.unionByName(divided.join(starts, _same(divided, starts, "conv_id", "k")).select(*divided.columns, "after", "start"))
    whole = whole.withColumn("last", F.col("k") == F.col("of"))
    return _mapped(whole, [*ORDER, "blank", "duplicate", "truncated"], ["codes", "copies", "after", "start", "last"], _letters, "audit string, cost bigint")


class _Conversation:
    """A conversation's repair as its audits and rows pass by in order."""

    def __init__(self, name) -> None:
        self.name, self.audits, self.at, self.state, self.place = name, [], 0, 0, 0
        self.blank = self.duplicate = self.truncated = self.cost = self.illegal = 0
        self.first_turn = self.last_turn = self.initial = None
        self.turns = self.piece = 0
        self.digest, self.began = hashlib.sha256(), False

    def chunk(self, audit: str, cost: int, blank: int, duplicate: int, truncated: int) -> None:
        self.audits.append(audit)
        self.cost, self.blank, self.duplicate, self.truncated = self.cost + cost, self.blank + blank, self.duplicate + duplicate, self.truncated + truncated

    def _letter(self) -> str:
        while self.piece < len(self.audits) and self.at == len(self.audits[self.piece]):
            self.piece, self.at = self.piece + 1, 0
        if self.piece == len(self.audits):
            return ""
        self.at += 1
        return self.audits[self.piece][self.at - 1]

    def _put(self, letter: str, turn, role: str, text: str) -> tuple:
        if letter != "K":
            self.state = FOLLOWS[self.state]
            role = "user" if self.state == 2 else "assistant"
        else:
            self.state = KEEPS["sua".index(role[:1])][self.state]
        self.place += 1
        self.digest.update((b"\n" if self.began else b"") + f"{role}:{text}".encode())
        self.began = True
        return self.name, self.place, letter, turn, role, text

    def row(self, turn, role: str, text: str, copies: int) -> Iterator[tuple]:
        if copies and turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn, self.last_turn = turn if self.first_turn is None else self.first_turn, turn
        for _ in range(copies):
            self.illegal += self.initial is not None and self.initial + role[:1] not in LEGAL
            self.initial = role[:1]
            while (letter := self._letter()) == "I":
                yield self._put("I", None, "", "")
            if letter != "D":
                yield self._put(letter, turn, role, text)

    def rest(self) -> Iterator[tuple]:
        while self._letter():
            yield self._put("I", None, "", "")

    def report(self) -> tuple:
        gaps = 0 if self.last_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return self.name, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audits), self.digest.hexdigest()


REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
REPAIRED = "place bigint, edit string, turn bigint, role string, text string"


def _repaired(rows: DataFrame, reports: bool, size: int, passes: int) -> DataFrame:
    rows = pick(rows, **{c: c for c in ("conv_id", "turn", "role", "text", "copies")}).withColumns({"head": F.substring("text", 1, HEAD), "digest": F.unhex(F.sha2("text", 256))})
    small_batches(rows.sparkSession)
    parts = audits(rows, size, passes).withColumns({"kind": F.lit(0), "copies": F.lit(0)}).withColumnRenamed("audit", "text")
    both = rows.withColumns({"kind": F.lit(1), **{c: F.lit(0).cast("bigint") for c in ("cost", "blank", "duplicate", "truncated")}}).unionByName(parts)
    names = ["conv_id", "turn", "role", "text", "copies", "kind", "cost", "blank", "duplicate", "truncated"]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none, done, weight, kind = object(), [], 0, None
        now = _Conversation(none)

        def flush() -> pa.RecordBatch:
            types = [kind, *([pa.int64()] * 6 + [pa.string()] * 2 if reports else [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()])]
            out = pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*done), types)], out_names)
            done.clear()
            return out

        def end() -> None:
            nonlocal weight
            if now.name is not none:
                found = list(now.rest())
                done.extend([now.report()] if reports else found)
                weight += len(done[-1][7]) if reports else 0

        for batch in batches:
            kind = batch.column("conv_id").type
            for name, turn, role, text, copies, what, *counts in zip(*[batch.column(c).to_pylist() for c in names]):
                if now.name is none or name != now.name:
                    end()
                    now = _Conversation(name)
                if what == 0:
                    now.chunk(text, *counts)
                else:
                    for put in now.row(turn, role, text, copies):
                        if not reports:
                            done.append(put)
                            weight += len(text)
                if weight > 4 << 20 or len(done) >= 1_000:
                    weight = 0
                    if done:
                        yield flush()
        end()
        if done:
            yield flush()

    out = REPORT if reports else REPAIRED
    out_names = ["conv_id", *[x.split()[0] for x in out.split(", ")]]
    in_order = both.repartition("conv_id").sortWithinPartitions(*ORDER, "kind").select(*names)
    return in_order.mapInArrow(finish, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {out}")


def repair_reports(rows: DataFrame, size: int = CHUNK, passes: int = PASSES) -> DataFrame:
    """One row per conversation: faults, cost and audit of its cheapest repair, and the digest of the repaired turns.

    ``rows`` has conv_id, turn (long), role, text and copies (how often a row stands there; 0 only
    names its conversation); other columns are ignored. A conversation's rows go by turn, nulls first; rows of one turn
    by role, the first HEAD characters of the text and its SHA-256. Its null conv_id is a conversation like others.
    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Null roles and texts must have been
    replaced (``damage`` makes them one space); an empty table gives no rows.

    Rows are dealt by ranges of that order and cut into chunks, so a hot conversation is the work of many
    tasks; texts move once, beside the audits. Only the last step, the digest of all repaired turns of a conversation,
    takes them one after the other, as any digest must; it holds one conversation's audit, no texts.
    """
    return _repaired(rows, True, size, passes)


def repaired_turns(rows: DataFrame, size: int = CHUNK, passes: int = PASSES) -> DataFrame:
    """The repaired turns: conv_id, place (from 1), edit (K kept, R role changed, I inserted), turn (null if inserted), role, text.

    Rows as for ``repair_reports``; conversations whose rows all go have none.
    """
    return _repaired(rows, False, size, passes)


def conversation_repairs(rows: DataFrame) -> DataFrame:
    """Reports on the repair of the damaged conversations table."""
    return repair_reports(damage(pick(rows, **{c: c for c in ("conv_id", "turn", "role", "text")})))
