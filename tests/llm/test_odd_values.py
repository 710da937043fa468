"""Values, not only row counts, of operators and of the pipeline's stages on odd rows."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import tiktoken

from pyspark.sql import functions as F

from deltaloom.llm import bpe, common, exact_dedup, line_dedup, lm_scoring, mixing, near_dedup, substring_dedup
from tests.llm.test_llm import PATTERN, RANKS, SF, WORD, components, every_shingle, frame, odd, shingles  # noqa: F401  odd is a fixture

SPACES = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def first(ids):
    """The least id, null only among nulls."""
    return min((i for i in ids if i is not None), default=None)


def counted(df, *names):
    return collections.Counter(tuple(r[n] for n in names) for r in df.collect())


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def token_row(reference, doc, text):
    ids = reference.encode_ordinary(text or "")
    return doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha(text or "")


def kept_lines(rows):
    """Texts without repeated or similar lines; rows that repeat id and text are one document."""
    distinct = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    places, lines = [], {}
    for doc, text in distinct:
        for k, line in enumerate((text or "").split("\n")):
            if line := line.strip(SPACES):
                places.append(((doc, text), k, line))
                lines.setdefault(line, len(lines))
    label = components({n: every_shingle(line) for line, n in lines.items()}, 0.8)
    seen, gone = set(), collections.defaultdict(set)
    for doc, k, line in places:
        if label[lines[line]] in seen:
            gone[doc].add(k)
        seen.add(label[lines[line]])
    return {d: d[1] if not gone[d] else "\n".join(x for k, x in enumerate(d[1].split("\n")) if k not in gone[d]) for d in distinct}


def near_classes(rows):
    """Class id of each row by its word set."""
    sets = {}
    for doc, text in rows:
        sets.setdefault(tuple(WORD.findall(text or "")), []).append(doc)
    keys = list(sets)
    label = components({i: shingles(" ".join(k)) or {()} for i, k in enumerate(keys)}, 0.8)
    ids = collections.defaultdict(list)
    for i, k in enumerate(keys):
        ids[label[i]] += sets[k]
    return {k: first(ids[label[i]]) for i, k in enumerate(keys)}


def test_exact(odd):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = collections.defaultdict(list)
    for doc, text in rows_of(odd):
        groups[norm(text)].append((-len(text or ""), doc is None, doc))
    want = collections.Counter((doc, min(groups[norm(text)])[2], len(groups[norm(text)]), sha(norm(text))) for doc, text in rows_of(odd))
    assert counted(exact_dedup.exact_dedup(odd), "doc_id", "keep_id", "group_size", "text_sha256") == want


def test_tokens(odd, reference):
    want = collections.Counter(token_row(reference, doc, text) for doc, text in rows_of(odd))
    assert counted(bpe.bpe_digests(odd, RANKS, PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_substrings(odd):
    words = [(doc, WORD.findall(text or "")) for doc, text in rows_of(odd)]
    seen = collections.Counter(tuple(w[k : k + 35]) for _, w in words for k in range(len(w) - 34))
    want = collections.Counter()
    for doc, w in words:
        gone = {k + j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(35)}
        want[doc, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))] += 1
    assert counted(substring_dedup.substring_digests(odd), "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_lines(odd):
    kept = kept_lines(rows_of(odd))
    assert counted(line_dedup.line_dedup(odd), "doc_id", "text") == collections.Counter((doc, kept[doc, text]) for doc, text in rows_of(odd))


def test_near_classes(odd):
    classes = near_classes(rows_of(odd))
    want = collections.Counter((doc, classes[tuple(WORD.findall(text or ""))]) for doc, text in rows_of(odd))
    assert counted(near_dedup.near_duplicates(odd), "doc_id", "class_id") == want


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_every_stage_of_the_pipeline(spark, odd, reference, table):
    """Each stage on what the one before gave, against its brute-force form."""
    import corpus_pipeline

    docs = odd if table == "odd" else common.documents(spark, SF)
    names = docs.columns
    rows = rows_of(docs)
    out = common.stored(corpus_pipeline.language(spark, docs, SF), "stage")
    assert out.columns == names and collections.Counter(rows_of(out)) == collections.Counter(r for r in rows if any(c.isalpha() for c in r[1] or ""))
    rows = rows_of(out)
    kept = kept_lines(rows)
    out = common.stored(corpus_pipeline.lines(spark, out, SF), "stage")
    assert out.columns == names and collections.Counter(rows_of(out)) == collections.Counter((doc, kept[doc, text]) for doc, text in rows)
    assert all(r.n_chars == len(r.text) for r in out.select("n_chars", "text").collect())
    rows = rows_of(out)
    classes = near_classes(rows)
    out = common.stored(corpus_pipeline.near_duplicates(spark, out, SF), "stage")
    left = rows_of(out)
    assert out.columns == names and set(left) <= set(rows) and len(left) == len(set(classes.values()) | ({None} if None in classes.values() else set()))
    assert sorted((classes[tuple(WORD.findall(text or ""))] for _, text in left), key=str) == sorted((doc for doc, _ in left), key=str)
    copies = collections.Counter()
    for r in mixing.mix_sources(out).collect():
        copies[r.doc_id] += r.copies
    out = common.stored(corpus_pipeline.mixing(spark, out, SF), "stage")
    taken = rows_of(out)
    assert out.columns == names and collections.Counter(doc for doc, _ in taken) == +copies and set(taken) <= set(left)
    got = counted(corpus_pipeline.tokens(spark, out, SF), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == collections.Counter(token_row(reference, doc, text) for doc, text in taken)


def test_pipeline_of_an_empty_table(spark, odd, tmp_path):
    import corpus_pipeline

    odd.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    nulls = frame(spark, [(None, None), (None, ""), (3, None), (4, "x" * random.Random(1).randint(1, 9))])
    nulls.write.parquet(str(tmp_path / "n" / "documents.parquet"))
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path / "n")).collect()} <= {4}


def test_rows_without_a_partner_do_not_move(spark):
    """Of 20,000 rows hardly more than the 700 with a partner are left for the join, nulls among them, and the join is the same."""
    big = spark.range(20_000).selectExpr("if(id = 7, null, id) AS id", "cast(id % 3 AS int) AS pos", "repeat('x', 9) AS line")
    small = common.stored(big.where("id IS NULL OR id % 29 = 4 OR id > 19990").selectExpr("id AS _id", "pos AS _pos"), "t")
    left = common.thinned(big, small, ["id", "pos"], ["_id", "_pos"])
    assert left.columns == big.columns and 690 < small.count() <= left.count() < 2_500
    on = F.expr("id <=> _id AND pos = _pos")
    got, want = (common.join_checked(big, small, on, rows=n, keys=(["id", "pos"], ["_id", "_pos"])) for n in (0, 1 << 20))
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(map(tuple, want.collect())) and got.count() == small.count()
    assert common.thinned(big, small.where("_id < 0"), ["id", "pos"], ["_id", "_pos"]).isEmpty()


def test_scoring_takes_small_batches(spark):
    """A task of the model holds 1,000 texts and their ids at once, not Spark's 10,000."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10000")
        scores = lm_scoring.lm_scores(frame(spark, [(i, f"some words of text {i}") for i in range(20)]), RANKS, PATTERN, train_windows=8)
        assert int(spark.conf.get(name)) <= common.BATCH_ROWS and scores.count() == 20
    finally:
        spark.conf.set(name, before)
