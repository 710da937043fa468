import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from deltaloom.llm import attention, binning, bpe, common, exact_dedup, fingerprints, huffman, language, line_dedup, linking, lm_scoring, mixing, near_dedup, queries, substring_dedup, token_files
from tests.oracle import connect, same

SF = "/root/testdata/sf0.001"
RANKS, PATTERN, JSON = common.tokenizer_path("byte_bpe_50k.tiktoken"), common.tokenizer_pattern(), common.tokenizer_path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, DOC_ID2 long, row string, digest string, c0 string, label int"


def frame(spark, texts):
    rows = [(i, t, "en" if i is not None and i % 2 else None, ["a", None, "b"][k % 3], None if t is None else len(t), i, "r", "d", None, 1) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing column names."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    long = " ".join(rng.choice(words) for _ in range(3000))
    line = "a line of several words that many documents repeat without change"
    return frame(spark, [(1, None), (2, ""), (3, "  \n\t"), (4, line + "\n" + "own words of four"), (5, line), (6, line), (6, line), (7, long), (8, long + " tail"), (9, "日本語のテキスト"), (None, "no id at all here"), (10, "same text\x0bhere"), (11, "same text here"), (12, "Naïve café ünï 😀 " * 3)])


@pytest.fixture(scope="module")
def docs(spark):
    return common.documents(spark, SF)


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


OPERATORS = {
    "exact": lambda d: exact_dedup.exact_dedup(d), "mix": lambda d: mixing.mix_sources(d), "mixed": lambda d: mixing.mix_documents(d), "language": lambda d: language.identify_languages(d), "identified": lambda d: language.keep_identified(d),
    "bpe": lambda d: bpe.bpe_digests(d, RANKS, PATTERN), "near": lambda d: near_dedup.near_duplicates(d), "near docs": lambda d: near_dedup.near_dedup(d), "files": lambda d: token_files.token_file_digests(d, JSON),
    "prints": lambda d: fingerprints.fingerprint_edits(d), "substring": lambda d: substring_dedup.substring_digests(d), "lines": lambda d: line_dedup.line_dedup(d), "line report": lambda d: line_dedup.line_dedup_report(d),
    "lm": lambda d: lm_scoring.lm_scores(d, RANKS, PATTERN, train_windows=64),
}
#: Operators with one row per input row.
WHOLE = {"exact", "mix", "language", "bpe", "near", "files", "prints", "substring", "lines", "line report", "lm"}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_and_empty_tables(odd, name):
    out = OPERATORS[name](odd)
    n = len(out.collect())
    assert n == odd.count() if name in WHOLE else 0 < n
    if name in ("lines", "identified", "near docs", "mixed"):
        assert out.columns == odd.columns
    assert OPERATORS[name](odd.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op2_mix_sources", "op4_exact_dedup", "op9_substring_dedup", "op13_source_divergence"])
def test_equals_sql(spark, name):
    same(queries.queries()[name](spark, SF), connect(SF), queries.oracle_sql()[name])


def test_exact_dedup_survives_digest_collisions(odd):
    key = lambda rows: sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in rows)
    weak = exact_dedup.exact_dedup(odd, digest=lambda norm: (F.crc32(norm) % 3).cast("string").cast("binary"))
    assert key(weak.collect()) == key(exact_dedup.exact_dedup(odd).collect())


def test_merge_index_takes_further_batches(spark):
    """Flushes and merges in turn keep the smallest identifier and the count of each digest."""
    rng, index, want = random.Random(2), exact_dedup.MergeIndex(spark), {}
    for step in range(6):
        rows = [(bytes([rng.randrange(40)]), rng.randrange(1000)) for _ in range(50)]
        for d, i in rows:
            best, n = want.get(d, (i, 0))
            want[d] = (min(best, i), n + 1)
        index.flush(spark.createDataFrame(rows, "digest binary, best long"))
        if step in (1, 3, 4):
            index.compact()
        assert {bytes(r.digest): (r.best, r.rows) for r in index.compacted().collect()} == want
    assert len(index.runs) == 2 and index.level == 3
    some = sorted(want)[3]
    assert [(r.best, r.rows) for r in index.entry(some).collect()] == [want[some]]
    keys = spark.createDataFrame([(some,), (b"none",)], "digest binary")
    assert [(r.best, r.rows) for r in index.lookup(keys).collect()] == [want[some]]


def test_repeated_rows_leave_one(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = frame(spark, [(1, text), (1, text), (2, text), (3, "other words"), (None, None), (None, None)])
    assert sorted(str(r.doc_id) for r in near_dedup.near_dedup(docs).collect()) == ["1", "3", "None"]


@given(st.lists(st.integers(1, 10_000), min_size=1, max_size=12))
@settings(max_examples=60, deadline=None)
def test_water_filling_by_hand(sizes):
    """The level of the operator's rule against repeated resharing."""
    weights = [[5, 2, 1][k % 3] for k in range(len(sizes))]
    total, capped = 1.5 * sum(sizes), set()
    while True:
        free = [k for k in range(len(sizes)) if k not in capped]
        left = total - sum(2 * sizes[k] for k in capped)
        level = left / sum(weights[k] for k in free) if free else 0
        over = {k for k in free if level * weights[k] > 2 * sizes[k]}
        if not over:
            break
        capped |= over
    want = [2 * s if k in capped else level * w for k, (s, w) in enumerate(zip(sizes, weights, strict=True))]
    order = sorted(range(len(sizes)), key=lambda k: 2 * sizes[k] / weights[k])
    levels, before = [], 0.0
    for place, k in enumerate(order):
        levels.append((2 * sizes[k] / weights[k], (total - before) / sum(weights[j] for j in order[place:])))
        before += 2 * sizes[k]
    rule = max((lv for ratio, lv in levels if ratio >= lv), default=None)
    got = [min(2 * s, rule * w) if rule is not None else 2 * s for s, w in zip(sizes, weights, strict=True)]
    assert np.allclose(got, want)


def test_mix_meets_targets(docs):
    rows = mixing.mix_sources(docs).collect()
    taken, target, largest = collections.Counter(), {}, collections.Counter()
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
        assert 0 <= r.copies <= 2
    assert abs(sum(target.values()) - 1.5 * sum(r.size for r in rows)) < 1e-3
    assert all(abs(taken[s] - target[s]) <= 2 * largest[s] for s in target)
    assert sorted(rows, key=str) == sorted(mixing.mix_sources(docs.repartition(7)).collect(), key=str)


def test_language_held_out(docs):
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = language.identify_languages(docs, held_fold=0).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97 and all(0 <= r.score <= 1 for r in rows)


def test_language_of_many_scripts_and_labels(spark):
    """40 languages of 30 letters each, none of them among the most frequent letters of all."""
    rng = random.Random(3)
    texts, langs = [], []
    for k in range(40):
        letters = [chr(0x4E00 + 30 * k + i) for i in range(30)]
        for _ in range(4 + k % 2):
            texts.append("".join(rng.choice(letters) for _ in range(120)))
            langs.append(f"l{k:02}")
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(zip(texts, langs, strict=True))], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identify_languages(docs, held_fold=None).collect()}
    assert [got[i] for i in range(len(texts))] == langs


def test_sample_takes_an_equal_share_of_each_row():
    parts = ["a" * 50_000, "b" * 300, "c" * 20_000]
    got = collections.Counter(language._shared(parts, 24_000))
    assert got["b"] == 300 and abs(got["a"] - got["c"]) <= 1 and 23_990 < sum(got.values()) <= 24_000
    model = language.CrossParser.fit({"long": "abcd" * 500, "short": "dcba" * 5})
    assert model.cost[0] == 1 and model.cost[1] < 1 and model.predict(["abcdabcd", "dcbadcba"])[0] == ["long", "short"]


def plain_phrases(text, sample):
    """Greedy parse of encoded texts, by substring search, lane by lane."""
    n = 0
    for at in range(0, len(text), language.LANE):
        lane = text[at : at + language.LANE]
        while lane:
            size = next((k for k in range(len(lane), 0, -1) if lane[:k] in sample), 1)
            lane, n = lane[size:], n + 1
    return n


@given(st.lists(st.text("tghab é日", min_size=1, max_size=40), min_size=2, max_size=3), st.lists(st.text("tghab é日ж!", max_size=30), max_size=5))
@settings(max_examples=150, deadline=None)
def test_phrases_equal_a_plain_parse(samples, texts):
    """Letters that one sample or all lack are phrases of their own."""
    model = language.CrossParser.fit({str(k): s for k, s in enumerate(samples)})
    word = lambda s: "".join(chr(c) for c in language._encode(s, model.symbols))
    texts += ["tgtgtgtg", "t" * 700 + "g" * 600]
    found, _ = model.phrases(texts)
    assert found.tolist() == [[plain_phrases(word(t), word(s)) for s in samples] for t in texts]


def test_sample_is_bounded_and_spread(spark):
    """Rows of one id are one sampled row; a long text gives pieces from its start to its end."""
    long = "".join(chr(97 + i * 26 // 100_000) for i in range(100_000))
    rows = [(1, f"text {i:04}", "en") for i in range(500)] + [(i, "w" * 50, "en") for i in range(2, 300)] + [(None, "null id", "fr"), (5, long, "de"), (6, None, "it"), (7, "no label", None)]
    found = language.labelled_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang", None, 64, 2_000)
    assert sorted(found) == ["de", "en", "fr"] and found["fr"] == "\nnull id"
    assert found["en"].count("text") <= 1 and len(found["en"]) <= 2_000
    assert {"a", "z"} <= set(found["de"]) and len(set(found["de"])) >= 9 and len(found["de"]) <= 2_000


def test_transitions_of_wide_rows():
    rng = random.Random(8)
    moves = [{c: rng.randrange(400) for c in rng.sample(range(900), rng.choice([0, 1, 2, 60, 700]))} for _ in range(400)]
    table = language.Transitions.of(moves, 900)
    at = np.divmod(np.arange(400 * 900), 900)
    assert table[at].tolist() == [moves[s].get(c, -1) for s in range(400) for c in range(900)]


@given(st.text("ab c", max_size=40), st.text("ab c", max_size=12))
@settings(max_examples=80, deadline=None)
def test_suffix_automaton_knows_all_substrings(text, part):
    code = {"a": 1, "b": 2, "c": 3, " ": 0}
    table = language.suffix_automaton(np.array([code[c] for c in text], np.int16), 4)
    state = 0
    for c in part:
        state = table[state, code[c]] if state >= 0 else -1
    assert (state >= 0) == (part in text)


@given(st.lists(st.sampled_from(["a", "b", " ", "  ", "\n", "é", "1", "!", "the", "ing", "😀", "'s", "\t", "中", "\x1c", "ab" * 40, "==", " ", "\r\n"]), max_size=14))
@settings(max_examples=300, deadline=None)
def test_bpe_equals_library(parts):
    import tiktoken

    text, encoder = "".join(parts), bpe.text_encoder(RANKS, PATTERN)
    reference = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=encoder.tree.ranks, special_tokens={})
    packed = encoder.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == reference.encode_ordinary(text) and encoder.decode(packed) == text.encode()


def test_bpe_on_documents(docs, texts):
    import tiktoken

    reference = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    for r in bpe.bpe_digests(docs, RANKS, PATTERN).collect():
        ids = reference.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


def test_bpe_ids_decode(odd):
    encoded = bpe.bpe_encode(odd, RANKS, PATTERN)
    got = sorted(bytes(r.data).decode() for r in bpe.bpe_decode(encoded, RANKS, PATTERN).collect())
    assert got == sorted(r.text or "" for r in odd.select("text").collect())


@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=300), st.integers(9, 18))
@settings(max_examples=60, deadline=None)
def test_huffman_lengths(counts, limit):
    lengths = huffman.code_lengths(np.array(counts, np.int64), limit)
    used = [n for n, c in zip(lengths, counts, strict=True) if c]
    assert all((n > 0) == (c > 0) for n, c in zip(lengths, counts, strict=True)) and max(used, default=0) <= limit
    assert sum(2.0 ** -int(n) for n in used) <= 1


@given(st.lists(st.lists(st.integers(0, 40), max_size=700), min_size=1, max_size=6))
@settings(max_examples=40, deadline=None)
def test_huffman_round_trip(runs):
    sizes, symbols = np.array([len(r) for r in runs], np.int64), np.array([s for r in runs for s in r], np.int64)
    lengths = huffman.code_lengths(np.bincount(symbols, minlength=41).astype(np.int64) ** 3)
    data, run_bytes, lanes = huffman.pack(symbols, sizes, huffman.canonical_codes(lengths), lengths)
    assert huffman.unpack(data, sizes, run_bytes, lanes, huffman.decoding_table(lengths)).tolist() == symbols.tolist()


def test_token_files(docs, texts):
    from tokenizers import Tokenizer

    library, start = Tokenizer.from_file(JSON), 0
    got = {r.doc_id: r for r in token_files.token_file_digests(docs, JSON).collect()}
    for i in sorted(texts):
        ids = library.encode(texts[i], add_special_tokens=False).ids + [0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def shingles(text, n=5):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))) if w else frozenset()


def test_fingerprints(docs, texts):
    got, ids, errors = {r.doc_id: r for r in fingerprints.fingerprint_edits(docs).collect()}, sorted(texts), []
    for k, i in enumerate(ids):
        a, b = texts[i], texts[ids[(k + 1) % len(ids)]]
        cut = len(a) // 4
        edit = a[: len(a) - cut] + b[:cut]
        assert got[i].n_chars == len(a) and got[i].edited_sha256 == hashlib.sha256(edit.encode()).hexdigest()
        x, y, z = shingles(a), shingles(edit), shingles(b)
        errors += [got[i].near_edited - len(x & y) / len(x | y), got[i].near_next - len(x & z) / len(x | z)]
    assert abs(np.mean(errors)) < 0.01 and np.sqrt(np.mean(np.square(errors))) < 0.05
    same_text = collections.defaultdict(set)
    for i in ids:
        same_text[texts[i]].add(got[i].fingerprint)
    assert all(len(v) == 1 for v in same_text.values())


def components(sets, threshold):
    parent, index = {k: k for k in sets}, collections.defaultdict(list)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        common_grams = collections.Counter(j for g in sets[i] for j in index[g])
        for j, n in common_grams.items():
            if n >= threshold * (len(sets[i]) + len(sets[j]) - n) - 1e-9:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for g in sets[i]:
            index[g].append(i)
    return {i: find(i) for i in sets}


def test_near_duplicates_equal_brute_force(docs, texts):
    want = components({i: shingles(t) or {()} for i, t in texts.items()}, 0.8)
    assert {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()} == want


def test_repeated_shingles_do_not_hide_near_copies(spark):
    """100 common shingles and a line repeated 1,000 times in one copy: near by sets, far apart by counts."""
    pairs = []
    for k in range(12):
        own = " ".join(f"a{k}x{i}" for i in range(104))
        pairs += [(2 * k, own), (2 * k + 1, own + (" " + " ".join(f"b{k}x{i}" for i in range(8))) * 1000)]
    sets = [shingles(t) for _, t in pairs[:2]]
    assert 0.8 < len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.95
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(frame(spark, pairs)).collect()}
    assert got == {i: i - i % 2 for i in range(24)}


def test_prob_minhash_estimates_probability_jaccard():
    rng = np.random.default_rng(0)
    grams = rng.integers(0, 2**63, 60).astype(np.uint64)
    w = np.stack([rng.integers(1, 5, 60), rng.integers(1, 5, 60)]).astype(float)
    w[0, :10] = w[1, 50:] = 0
    exact = sum(1 / sum(max(w[0, e] / w[0, d], w[1, e] / w[1, d]) for e in range(60)) for d in range(60) if w[0, d] and w[1, d])
    s = [near_dedup.prob_minhash(grams[w[k] > 0], w[k][w[k] > 0], np.zeros((w[k] > 0).sum(), np.int64), 1, 4096)[0] for k in (0, 1)]
    assert abs(np.mean(s[0] == s[1]) - exact) < 0.04


def test_large_buckets_lose_no_link(spark):
    """A chain inside one bucket: each id is near the next only, all share one key."""
    rows = [(i, [7], list(range(i * 10, i * 10 + 100))) for i in range(60)] + [(100 + i, [7], [10_000 + 500 * i + j for j in range(50)]) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, keys array<long>, grams array<long>")
    entries, grams = common.stored(df.select("id", "keys"), "t"), df.select("id", "grams")
    labels = {r.id: r.label for r in linking.link_buckets(entries, lambda ids: grams.join(ids, "id"), 0.8).collect()}
    assert labels == {i: 0 for i in range(60)}


def test_pairs_are_cut_by_size_and_sets_by_pairs_before_sets_move(spark):
    grams = common.stored(spark.createDataFrame([(i, [i], 1 + i) for i in range(20)], "id long, grams array<long>, n int"), "grams")
    pairs = common.stored(spark.createDataFrame([(1, 2), (1, 9), (10, 11)], "a long, b long"), "pairs")
    assert [tuple(r) for r in linking._of_similar_size(pairs, grams, 0.8).collect()] == [(10, 11)]
    assert sorted(r.id for r in linking._paired(pairs, grams).collect()) == [1, 2, 9, 10, 11]


def test_families_in_one_bucket_compare_in_proportion(spark, monkeypatch):
    """Four families of near copies share one bucket and no other: what is compared grows with the members, not with their square."""
    compared, plain = [], linking._near

    def near(pairs, *rest):
        pairs = common.stored(pairs, "pairs")
        compared.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(linking, "_near", near)
    for m in (40, 80):
        rng, compared[:] = random.Random(m), []
        rows = []
        for family in range(4):
            base = [family * 1_000 + i for i in range(100)]
            for k in range(m):
                rows.append((family * 500 + k, [1], [x for x in base if x not in rng.sample(base, 4)] + [10_000 + family * 50_000 + k * 10 + j for j in range(4)]))
        rows.append((5_000, [1], [i for i in range(95)] + [99_000 + i for i in range(20)]))  # far from each guide, near one family
        df = common.stored(spark.createDataFrame(rows, "id long, keys array<long>, grams array<long>"), "families")
        labels = {r.id: r.label for r in linking.link_buckets(df.select("id", "keys"), lambda ids: df.join(ids, "id").select("id", "grams"), 0.8).collect()}
        want = components({i: frozenset(g) for i, _, g in rows}, 0.8)
        assert {i: labels.get(i, i) for i, _, _ in rows} == want
        assert sum(compared) < 30 * 4 * m


@pytest.mark.parametrize("edits, base_there", [(14, True), (16, False), (12, True)])
def test_large_buckets_of_near_copies_equal_brute_force(spark, edits, base_there):
    """600 edited copies of one set near the threshold: as many link to the base as not, and some of these to each other only."""
    rng = random.Random(edits)
    base = list(range(80))
    sets = {0: frozenset(base)} if base_there else {}
    for i in range(1, 600):
        if i % 9 == 0 and i - 1 in sets:  # a near copy of a copy
            some = set(sets[i - 1])
            some -= set(rng.sample(sorted(some), rng.randint(2, 9)))
        else:
            gone = {(at + k) % 80 for at in rng.sample(range(80), rng.randint(1, 6)) for k in range(rng.randint(2, edits // 3))}
            some = set(base) - gone | {1000 * i + g for g in rng.sample(sorted(gone), len(gone) * 2 // 3)} | ({10**6 + i % 5} if i % 2 else set())
        sets[i] = frozenset(some)
    want = components(sets, 0.8)
    linked = collections.Counter(want.values())
    df = spark.createDataFrame([(i, [7, 8 + i % 3], sorted(x)) for i, x in sets.items()], "id long, keys array<long>, grams array<long>")
    entries, grams = common.stored(df.select("id", "keys"), "t"), df.select("id", "grams")
    labels = {r.id: r.label for r in linking.link_buckets(entries, lambda ids: grams.join(ids, "id"), 0.8).collect()}
    assert labels == {i: c for i, c in want.items() if linked[c] > 1} and 50 < len(labels) and len(set(want.values())) > 10


def test_components_of_a_path(spark):
    edges = spark.range(1, 200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.label for r in linking.connected_components(edges).collect()} == {1}


def test_substring_dedup_equals_brute_force(docs, texts):
    words = {i: WORD.findall(t) for i, t in texts.items()}
    seen = collections.Counter(tuple(w[k : k + 35]) for w in words.values() for k in range(len(w) - 34))
    for r in substring_dedup.substring_digests(docs).collect():
        w = words[r.doc_id]
        keep = [True] * len(w)
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                keep[k : k + 35] = [False] * 35
        kept = [x for x, y in zip(w, keep, strict=True) if y]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())


def test_substring_factors_stand_in_the_reference(spark):
    """A factor ends where its reference goes on with other words, and the windows across the boundary are found."""
    a, b, c = ([f"{x}{i}" for i in range(60)] for x in "abc")
    texts = [a + b, b + a[:50] + c, ["x"] + a[10:60] + b[:20] + ["y"], c[5:45]]
    docs = frame(spark, [(i, " ".join(w)) for i, w in enumerate(texts)])
    copies = substring_dedup.copied_texts(docs)
    got = {r._doc: sorted((f.start, f.end, bytes(f.digest)) for f in r.factors) for r in substring_dedup.repeated_factors(docs, copies).collect()}
    spans = {0: [(0, 60), (10, 80), (60, 120)], 1: [(0, 60), (60, 110), (115, 155)], 2: [(1, 71)], 3: [(0, 40)]}
    for i, found in got.items():
        assert [d for _, _, d in found] == [hashlib.sha256(" ".join(texts[i][s:e]).encode()).digest() for s, e, _ in found]
        covered = lambda x: {k for s, e in x for k in range(s, e)}
        assert covered([(s, e) for s, e, _ in found]) == covered(spans[i])
    assert [(s, e) for s, e, _ in got[3]] == [(0, 40)]


def test_substring_repeats_in_one_document(spark):
    w = [f"w{i}" for i in range(40)]
    got = substring_dedup.substring_dedup(frame(spark, [(1, " ".join(w + ["x"] + w)), (2, "y " * 36)])).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept) for r in got] == [(81, 80, "x"), (36, 36, "")]


def test_line_dedup_equals_brute_force(docs, texts):
    first, places = {}, []
    for i in sorted(texts):
        for k, line in enumerate(texts[i].split("\n")):
            if line := line.strip(" \t\n\x0b\x0c\r"):
                places.append((i, k, line))
                first.setdefault(line, (i, k))
    order = {line: n for n, line in enumerate(first)}
    label = components({n: every_shingle(line) for line, n in order.items()}, 0.8)
    keep = {}
    for line, n in order.items():
        keep[label[n]] = min(keep.get(label[n], first[line]), first[line])
    want = collections.defaultdict(list)
    for i, k, line in places:
        if keep[label[order[line]]] != (i, k):
            want[i].append(k)
    got = {r.doc_id: r.dropped for r in line_dedup.line_dedup_report(docs).collect()}
    assert {i: v for i, v in got.items() if v} == dict(want)


def every_shingle(line):
    return frozenset(line[i : i + 8] for i in range(max(len(line) - 7, 1)))


def test_char_shingles_start_at_every_character(spark):
    lines = ["a", "seven77", "eight888", "nine 9999", "x" * 31, "日本語😀のテキスト" * 9, " ".join(f"w{i}" for i in range(60))] + ["".join(chr(97 + i * i % 23) for i in range(n)) for n in (38, 39, 40, 41, 64, 71, 72, 103)]
    got = spark.createDataFrame([(x,) for x in lines], "line string").select(F.size(line_dedup.char_shingles(F.col("line"))).alias("n")).collect()
    assert [r.n for r in got] == [len(every_shingle(x)) for x in lines]


def test_line_registers_agree_like_the_sets(spark):
    """With one register a band, as many bands of 300 pairs agree as their similarities say."""
    rng = random.Random(4)
    rows, likeness = [], []
    for k in range(300):
        a = "".join(rng.choice("abcdefghij ") for _ in range(rng.randint(5, 300)))
        at = rng.randrange(len(a))
        b = a[:at] + "#" * rng.randint(1, 20) + a[at + rng.randint(0, 20) :]
        x, y = every_shingle(a), every_shingle(b)
        rows += [(f"{k}a".encode(), a), (f"{k}b".encode(), b)]
        likeness.append(len(x & y) / len(x | y))
    keys = {r.digest: r["keys"] for r in line_dedup.line_keys(spark.createDataFrame(rows, "digest binary, line string"), 8, 1).collect()}
    same = [p == q for k in range(300) for p, q in zip(keys[f"{k}a".encode()], keys[f"{k}b".encode()], strict=True)]
    assert len(keys) == 600 and abs(np.mean(same) - np.mean(likeness)) < 0.03


def test_line_links_by_shingles_at_every_character(spark):
    """Pairs with one letter changed: near ones (by brute force at every character) lose their later line, others do not."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
    texts, want = [], []
    for k in range(80):
        line = " ".join(word() for _ in range(rng.randint(8, 16)))
        at = rng.choice([i for i, c in enumerate(line) if c != " "])
        other = line[:at] + "#" + line[at + 1 :]
        a, b = every_shingle(line), every_shingle(other)
        texts += [(2 * k, line), (2 * k + 1, other)]
        want.append(len(a & b) / len(a | b) >= 0.8)
    got = {r.doc_id: r.n_dropped for r in line_dedup.line_dedup_report(frame(spark, texts)).collect()}
    assert 20 < sum(want) < 75
    lost = [k for k in range(80) if want[k] and not got[2 * k + 1]]
    assert not any(got[2 * k + 1] for k in range(80) if not want[k]) and len(lost) <= 1 and not any(got[2 * k] for k in range(80))


def test_binned_minima_ignore_order(spark):
    df = spark.createDataFrame([([5, 9, -3, 77],), ([77, 5, -3, 9, 9],), ([],)], "g array<long>")
    a, b, c = [r.m for r in binning.binned_minima(df, "g", "m", 16).collect()]
    assert a == b and len(a) == 16 and c is None


def test_base_scores_and_windows(docs, texts):
    words = {i: [w for w in WORD.findall(t.encode().lower().decode())] for i, t in texts.items()}
    train = [i for i in texts if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = collections.Counter(w for i in train for w in words[i])
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    for r in lm_scoring.lm_scores(docs, RANKS, PATTERN, train_windows=128).collect():
        c = [counts[w] for w in words[r.doc_id]] + [len(train)]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(c), sum(x > 0 for x in c), n, r.doc_id not in set(train))
        assert abs(r.base_score - sum(np.log10((x + 0.5) / (n + 0.5 * (v + 1))) for x in c)) < 1e-6 and r.score < 0


def test_scores_do_not_depend_on_the_broadcast_pairs(docs):
    few = docs.where("doc_id % 5 = 0")
    scores = [{(r.doc_id): r.score for r in lm_scoring.lm_scores(few, RANKS, PATTERN, train_windows=32, head_pairs=n).collect()} for n in (lm_scoring.MAX_PAIRS, 50)]
    assert scores[0].keys() == scores[1].keys() and all(abs(scores[0][i] - scores[1][i]) < 1e-4 * max(1, abs(scores[0][i])) for i in scores[0])


def test_the_broadcast_head_is_cut_by_frequency_alone(spark):
    """No pair outside the head is as frequent as one in it, so nothing has to be sorted to choose it; it keeps within its bound."""
    counts = common.stored(spark.range(5_000).selectExpr("id AS pair", "1 + cast(5000 / (1 + (id * 7) % 5000) AS long) AS n"), "t")
    n = {r.pair: r.n for r in counts.collect()}
    found = lm_scoring.Successors(5_000, counts, None, None, None)
    for rows in (0, 1, 300, 4_999, 5_000):
        pair, times = found.head(rows)
        assert len(pair) <= rows and pair.tolist() == sorted(pair) and times.tolist() == [n[p] for p in pair.tolist()]
        assert not len(pair) or min(times) > max([x for p, x in n.items() if p not in set(pair.tolist())], default=0)
    assert len(found.head(5_000)[0]) == 5_000 and len(found.head(300)[0]) > 150


def test_training_windows_grow_with_the_ids(docs, monkeypatch):
    """Windows beyond the first task's take part: with few ids a window the weights differ, and repeat exactly."""
    few = docs.where("doc_id % 5 = 0")
    run = lambda: {r.doc_id: r.score for r in lm_scoring.lm_scores(few, RANKS, PATTERN, train_windows=8).collect()}
    monkeypatch.setattr(lm_scoring, "WINDOW_IDS", 10**9)
    first = run()
    monkeypatch.setattr(lm_scoring, "WINDOW_IDS", 256)
    grown = run()
    assert grown == run() and sum(grown.values()) > sum(first.values())


def test_weights_are_fitted_on_every_training_position(spark):
    """The windows of the pass hold each successor of each training text as often as the counts do, in pieces too."""
    rng, size, end = np.random.default_rng(2), 302, 301
    texts = [rng.integers(0, 300, n).astype("<u2").tobytes() for n in (0, 1, 31, 32, 33, lm_scoring.PIECE - 1, lm_scoring.PIECE, 2 * lm_scoring.PIECE + 7)]
    tokens = spark.createDataFrame([(i, i % 3, i != 2, t) for i, t in enumerate(texts)], "doc_id long, row long, train boolean, ids binary")
    found = lm_scoring._successors(tokens, size, end)
    pieces = lm_scoring._pieces(tokens, end)
    x, y, real = lm_scoring._window_arrays([r.ids for r in pieces.collect()], end)
    pairs, n = np.unique((x * size + y)[real], return_counts=True)
    assert dict(zip(pairs.tolist(), n.tolist())) == {r.pair: r.n for r in found.pairs.collect()}
    shared = spark.sparkContext.broadcast((*found.head(50), found.totals, found.kinds, found.ids))
    fits = lm_scoring._fitted(pieces.selectExpr("pmod(key, 2) AS shard", "key", "ids"), found, shared, end, None, epochs=1).collect()
    assert sum(r.n for r in fits) == real.sum() == sum(len(t) // 2 + 1 for i, t in enumerate(texts) if i != 2)


@given(st.lists(st.integers(0, 130), min_size=1, max_size=5))
@settings(max_examples=50, deadline=None)
def test_windows_score_each_id_once(sizes):
    ids = np.arange(sum(sizes)) + 5
    inputs, targets, counted, owner = attention.windows(ids, np.array(sizes), 1)
    want, at = [], 0
    for s in sizes:
        want += [*ids[at : at + s], 1]
        at += s
    assert targets[counted].tolist() == want


def test_scores_equal_a_plain_rescore():
    """Position by position: each id by the probabilities of the one window that counts it."""
    rng = np.random.default_rng(3)
    size, end = 60, 59
    sizes = np.array([0, 1, 23, 24, 31, 32, 33, 55, 56, 57, 200, 0, 311])
    ids = rng.integers(0, 59, sizes.sum())
    pairs = np.unique(rng.integers(0, size * size, 700))
    counts = attention.CorpusCounts.of(size, pairs // size, pairs % size, rng.integers(1, 9, len(pairs)), np.full(size, 60), rng.integers(0, 50, size), np.full(size, 12))
    model = attention.AttentionModel(size, counts)
    inputs, targets, counted, owner = attention.windows(ids, sizes, end)
    p = np.log10(model.probabilities(inputs, targets).astype(np.float64))
    want = [p[owner == k][counted[owner == k]].sum() for k in range(len(sizes))]
    np.testing.assert_allclose(model.score(ids, sizes, end, batch=7), want, rtol=1e-4)
    assert [int(counted[owner == k].sum()) for k in range(len(sizes))] == (sizes + 1).tolist()
    known, text, keys, plain, weight = model.score_parts(ids, sizes, end)
    again = known + np.bincount(text, np.log10(plain.astype(np.float64)), minlength=len(sizes))
    np.testing.assert_allclose(again, want, rtol=1e-4)
    assert not np.isin(keys, counts.pairs).any() and (weight > 0).all()


def test_attention_is_causal_and_normalised():
    size = 40
    rng = np.random.default_rng(0)
    prev, nxt = rng.integers(0, size, 200), rng.integers(0, size, 200)
    keys, n = np.unique(prev * size + nxt, return_counts=True)
    counts = attention.CorpusCounts.of(size, keys // size, keys % size, n, np.bincount(keys // size, n, size).astype(np.int64), np.bincount(keys % size, n, size))
    model = attention.AttentionModel(size, counts)
    x = rng.integers(0, size, (1, attention.CONTEXT))
    total = sum(model.probabilities(x, np.full_like(x, t)) for t in range(size))
    assert np.allclose(total, 1, atol=1e-3)
    y = x.copy()
    y[0, 20:] = (y[0, 20:] + 1) % size
    assert np.allclose(model.probabilities(x, x)[0, :20], model.probabilities(y, x)[0, :20], atol=1e-6)


def test_attention_gradients_by_differences():
    size = 12
    rng = np.random.default_rng(1)
    counts = attention.CorpusCounts.of(size, np.array([0, 1]), np.array([1, 2]), np.array([3, 4]), np.ones(size, np.int64) * 5, np.ones(size))
    model = attention.AttentionModel(size, counts)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    model.freeze()
    model.table = np.exp(model.w["table"]) / np.exp(model.w["table"]).sum(axis=0)
    x, y = rng.integers(0, size, (2, attention.CONTEXT)), rng.integers(0, size, (2, attention.CONTEXT))

    def loss():
        model.table = np.exp(model.w["table"]) / np.exp(model.w["table"]).sum(axis=0)
        return -np.log(model.probabilities(x, y)).mean()

    grads = model._gradients(x, y)
    for name, w in model.w.items():
        at = tuple(rng.integers(0, n) for n in w.shape)
        w[at] += 1e-5
        up = loss()
        w[at] -= 2e-5
        down = loss()
        w[at] += 1e-5
        assert abs((up - down) / 2e-5 - grads[name][at]) < 1e-4 * max(1, abs(grads[name][at])), name


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = common.documents(spark, SF)
    first = corpus_pipeline.language(spark, docs, SF)
    assert first.columns == docs.columns and first.count() == docs.where("text RLIKE '\\\\p{L}'").count()
    taken = corpus_pipeline.mixing(spark, docs, SF)
    copies = {r.doc_id: r.copies for r in mixing.mix_sources(docs).collect()}
    assert collections.Counter(r.doc_id for r in taken.select("doc_id").collect()) == collections.Counter({i: c for i, c in copies.items() if c})
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100
