import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from deltaloom.llm import conversations, queries, viterbi

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, place int, AUDIT string, n string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fault = zlib.crc32(name.encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3][:16].encode(), hashlib.sha256(r[3].encode()).digest()))


def cheapest(rows):
    """Least (cost, audit) and its turns over all edits, rows as (role, text, must go, truncated); knows the pattern only."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, initials, turns = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, turns
        if not re.fullmatch("s?(ua)*u?", initials) or (i, initials[-1:]) in seen:
            continue
        seen.add((i, initials[-1:]))
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 2, audit + "I", i, initials + role[0], turns + (f"{role}:",)))
        if i < len(rows):
            role, text, gone, truncated = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, initials, turns))
            if not gone:
                if role[:1]:
                    heapq.heappush(heap, (cost + truncated, audit + "K", i + 1, initials + role[0], turns + (f"{role}:{text}",)))
                for new in ("user", "assistant"):
                    heapq.heappush(heap, (cost + 2 + truncated, audit + "R", i + 1, initials + new[0], turns + (f"{new}:{text}",)))
    raise AssertionError


def plain_report(conv, rows):
    """From the contract, for the damaged rows of one conversation."""
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    rows, seen, marked, counts = in_order(rows), set(), [], [0, 0, 0]
    for _, _, role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        fault = 0 if not end else 1 if (role, text) in seen else 2 if end[-1] not in ".!?" else 3
        seen.add((role, text))
        if fault < 3:
            counts[fault] += 1
        marked.append((role, text, fault < 2, fault == 2))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, kept = cheapest(marked)
    return conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()


def expected(rows):
    by = defaultdict(list)
    for r in plain_damage(rows):
        by[r[0]].append(r)
    return sorted((plain_report(c, by[c]) for c in {r[0] for r in rows}), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "n") for r in rows], SCHEMA)


def result(df):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


CODES = st.lists(st.integers(0, 7), max_size=9)


@given(CODES)
@settings(max_examples=300, deadline=None)
def test_traces_equal_a_search_over_all_edits(codes):
    rows = [("suax"[c & 3], "", False, c >> 2) for c in codes]
    cost, audit, _ = cheapest(rows)
    letters, state = viterbi.trace(bytes(codes), viterbi.END, 0)
    assert "".join(letters) + viterbi.ending(state) == audit
    v = viterbi.END
    for code in reversed(codes):
        v = viterbi.before(code, v)
    assert v[0] == cost and viterbi.level(v) == viterbi.backward(bytes(codes), viterbi.END)


@given(CODES, CODES)
@settings(max_examples=200, deadline=None)
def test_vectors_and_matrices_of_chunks(first, second):
    whole, a, b = bytes(first + second), bytes(first), bytes(second)
    speculative = viterbi.backward(a, viterbi.END)
    assert viterbi.fixed_up(a, viterbi.backward(b, viterbi.END), viterbi.END, speculative) == viterbi.backward(whole, viterbi.END)
    m = viterbi.matrix(whole)
    assert viterbi.level(tuple(min(m[4 * i + j] + viterbi.END[j] for j in range(4)) for i in range(4))) == viterbi.backward(whole, viterbi.END)


def test_conversations_equal_a_search_over_all_edits(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(queries.queries()["op12_conversation_repair"](spark, SF)) == expected(rows)


def random_rows(seed, convs=30):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut", "cut \t", "", " \n", None, "One two three four five six.", "One two three four five seven.", "é?", "sixteen letters and more"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "umpire", "Sys"]
    out = []
    for conv in [None, *range(convs)]:
        for turn in range(rng.randint(1, 14)):
            row = (conv, rng.choice([turn, turn, turn, None, 2 * turn, -turn]), rng.choice(roles), rng.choice(texts))
            out += [row] * rng.choice([1, 1, 1, 2])
    return out


@pytest.mark.parametrize("size,passes", [(4_096, 6), (1, 6), (2, 1), (3, 0)])
def test_odd_rows_in_chunks(spark, size, passes):
    """Nulls, ties, repeated rows, odd roles; small chunks make every conversation go over several, with and without matrices."""
    rows = random_rows(size)
    damaged = conversations.damage(frame(spark, rows))
    assert result(conversations.repair_reports(damaged, size, passes)) == expected(rows)


def test_unknown_roles_never_converge_but_settle(spark):
    rows = [(1, t, "tool", f"text {t}.") for t in range(41)]
    assert result(conversations.repair_reports(conversations.damage(frame(spark, rows)), 2, 3)) == expected(rows)


def test_repaired_turns(spark):
    rows = random_rows(9, convs=12)
    found = defaultdict(list)
    for r in conversations.repaired_turns(conversations.damage(frame(spark, rows)), 3).collect():
        found[r.conv_id].append(r)
    for conv, *_, audit, digest in expected(rows):
        turns = sorted(found[conv], key=lambda r: r.place)
        assert [r.place for r in turns] == list(range(1, len(turns) + 1))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in turns).encode()).hexdigest() == digest
        assert "".join(r.edit for r in turns) == audit.replace("D", "")


def test_conversations_without_rows(spark):
    gone = [(c, t) for c in range(200) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:2]
    rows = [(*g, "user", "a.") for g in gone]
    empty = hashlib.sha256(b"").hexdigest()
    assert result(conversations.conversation_repairs(frame(spark, rows))) == sorted(((c, 0, 0, 0, 0, 0, 0, "", empty) for c, _ in gone), key=str)
    assert conversations.conversation_repairs(frame(spark, [])).collect() == []
