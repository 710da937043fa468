import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from deltaloom.llm import common, simhash

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, print string, least int, LABEL string, key string"


def plain_simhash(text, words=3):
    """Bit by bit, from the contract."""
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=2):
    """Root of each print over all pairs."""
    up = {p: p for p in prints}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= radius and root(a) != root(b):
                up[max(root(a), root(b))] = min(root(a), root(b))
    return {p: root(p) for p in prints}


def expected(rows):
    prints = {i: plain_simhash(t) for i, (_, t) in enumerate(rows)}
    roots = plain_components(sorted(set(prints.values())))
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        least[roots[prints[i]]].append(doc)
    first = {r: min([d for d in ids if d is not None], default=None) for r, ids in least.items()}
    return sorted(((doc, f"{prints[i]:016x}", first[roots[prints[i]]]) for i, (doc, _) in enumerate(rows)), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


@given(st.text(alphabet="aAbZ é\t\x0b\x85 日\n", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint_by_the_contract(text):
    assert simhash.simhash(text.encode()) == plain_simhash(text)


def test_documents_equal_brute_force(spark):
    docs = common.documents(spark, SF)
    assert result(simhash.simhash_components(docs)) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    long = " ".join(rng.choice(words) for _ in range(70_000))
    rows = [(5, None), (4, ""), (9, " \t\n"), (None, "no id here at all"), (None, "no id here at all"), (8, "no id here at all"), (7, "One two"), (7, "one TWO"), (6, "one\x0btwo"), (None, "alone without an id"), (2, long), (1, long + " tail"), (3, "İ é 日本 A")]
    found = result(simhash.simhash_components(spark.createDataFrame([(d, t, "x", 1, "y", "z") for d, t in rows], SCHEMA)))
    assert found == expected(rows)
    assert (5, "0" * 16, 4) in found and (None, f"{plain_simhash('alone without an id'):016x}", None) in found
    assert simhash.simhash_components(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_bit_sliced_runs_equal_all_pairs(radius):
    rng = random.Random(radius)
    centres = [rng.getrandbits(64) for _ in range(6)]
    prints = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(60)} | {rng.getrandbits(64) for _ in range(70)})
    keys = np.sort(np.array([rng.randrange(3) for _ in prints]))
    found = simhash.linked_runs(keys, np.array(prints, np.uint64), radius)
    for k in range(3):
        at = np.flatnonzero(keys == k)
        roots = plain_components([prints[i] for i in at], radius)
        assert [prints[found[i]] for i in at] == [roots[prints[i]] for i in at]


@pytest.mark.parametrize("large", [4, 1024])
def test_links_across_buckets(spark, monkeypatch, large):
    """With large = 4 nearly all links are found in the finer buckets."""
    monkeypatch.setattr(simhash, "LARGE", large)
    rng = random.Random(11)
    centres = [rng.getrandbits(64) for _ in range(5)]
    prints = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for c in centres for _ in range(80)})
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    links = simhash.link_prints(common.stored(spark.createDataFrame([(x,) for x in signed], "print long"), "prints"))
    label = {r.id & 0xFFFFFFFFFFFFFFFF: r.label & 0xFFFFFFFFFFFFFFFF for r in links.collect()}
    found, whole = defaultdict(set), defaultdict(set)
    for p in prints:
        found[label.get(p, p)].add(p)
    for p, root in plain_components(prints).items():
        whole[root].add(p)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, whole.values()))


def test_radius_is_checked(spark):
    with pytest.raises(ValueError):
        simhash.link_prints(spark.createDataFrame([], "print long"), 3)
