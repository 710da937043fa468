import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from deltaloom.llm import common, divergence, packing

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, term string, n int, LANG_N string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def plain_terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def plain_audit(rows, least=10, top=10):
    """From the contract, over (text, lang, source) rows."""
    rows = [(plain_terms(t), l or "", s or "") for t, l, s in rows]
    docs, counts = Counter(), defaultdict(Counter)
    for terms, lang, source in rows:
        docs.update((lang, t) for t in set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang in {l for l, _ in counts}:
        kept = sorted(t for (l, t), n in docs.items() if l == lang and n >= least)
        groups = {s: c for (l, s), c in counts.items() if l == lang}
        whole = Counter()
        for c in groups.values():
            whole.update(c)

        def p(c, kept=kept):
            total = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // total for t in kept}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        shares, q = {s: p(c) for s, c in groups.items()}, p(whole)
        for s, own in shares.items():
            pairs = sorted((-sum(f(own[t], x[t]) for t in kept), o.encode()) for o, x in shares.items() if o != s)
            terms = sorted((-f(own[t], q[t]), t.encode()) for t in kept if groups[s][t] and own[t] > q[t])[:top]
            out += [(lang, s, part, item.decode(), -v, r) for part, found in (("pair", pairs), ("term", terms)) for r, (v, item) in enumerate(found, 1)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@given(st.lists(st.text(alphabet="aAzZ@[`{é日\x7f\x80\n 0😀", max_size=60), min_size=1, max_size=6), st.lists(st.integers(0, 2), min_size=6, max_size=6))
@settings(max_examples=200, deadline=None)
def test_packed_counts_equal_plain_counts(texts, groups):
    groups = np.sort(groups[: len(texts)])
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(x) for x in data])
    lowered, starts, ends, counts = packing.term_spans(np.frombuffer(b"".join(data), np.uint8), offsets)
    found = {}
    for terms, g, n, owners in packing.count_terms(lowered, starts, ends, np.repeat(np.arange(len(texts)), counts), groups):
        for row in zip(terms, g.tolist(), n.tolist(), owners.tolist()):
            assert found.setdefault((row[0].decode(), row[1]), row[2:]) == row[2:]
    occurrences, having = Counter(), Counter()
    for t, g in zip(texts, groups.tolist()):
        terms = plain_terms(t)
        occurrences.update((x, g) for x in terms)
        having.update((x, g) for x in set(terms))
    assert found == {k: (n, having[k]) for k, n in occurrences.items()}


@given(st.lists(st.tuples(st.integers(0, 2**64 - 1), st.integers(0, 3)), max_size=50))
def test_radix_order_is_a_stable_sort(pairs):
    columns = [np.array([p[k] for p in pairs], np.uint64) for k in (1, 0)]
    assert packing.radix_order(columns, np.arange(len(pairs))).tolist() == sorted(range(len(pairs)), key=lambda i: (pairs[i][1], pairs[i][0]))


@given(st.integers(0, 10**14), st.integers(1, 10**15))
def test_shares_are_exact(count, more):
    total = count + 2 + more
    assert divergence.shares(np.array([[count]]), np.array([total]))[0, 0] == 1 + 10**9 * (count + 2) // total


@pytest.mark.parametrize("cells", [divergence.CELLS, 40])
def test_documents_equal_brute_force(spark, monkeypatch, cells):
    """With 40 cells a language's terms are dealt over many blocks."""
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "MOST_CELLS", cells)
    docs = common.documents(spark, SF)
    assert result(divergence.source_divergence(docs, least=5)) == plain_audit([(r.text, r.lang, r.source) for r in docs.collect()], least=5)


def test_odd_rows(spark):
    rng = random.Random(2)
    words = ["Alpha", "beta", "ÉCLAIR", "x" * 8, "y" * 9, "z" * 16, "w" * 17, "日本語のテキスト", "v" * 3000]
    rows = [(" ".join(rng.choice(words) for _ in range(rng.randint(0, 9))), rng.choice(["en", None, "", "de"]), rng.choice(["a", None, "b", "é"])) for _ in range(120)]
    rows += [(None, "en", "silent"), ("", "fr", "only"), ("123 456", "es", "p"), (None, "es", "q"), ("\x00Alpha\x00", "en", "a")] + [rows[0]] * 3
    frame = spark.createDataFrame([(i, t, l, s, "t", 1, "n") for i, (t, l, s) in enumerate(rows)], SCHEMA)
    found = result(divergence.source_divergence(frame))
    assert found == plain_audit(rows)
    assert [r for r in found if r[0] == "es"] == [("es", "p", "pair", "q", 0, 1), ("es", "q", "pair", "p", 0, 1)] and not [r for r in found if r[0] == "fr"]
    assert [r for r in found if r[:3] == ("en", "silent", "pair")] and not [r for r in found if r[:3] == ("en", "silent", "term")]
    assert divergence.source_divergence(spark.createDataFrame([], SCHEMA)).collect() == []
