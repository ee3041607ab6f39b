"""The pipeline's near-duplicate stage against brute force."""

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from spanfeat.llm import near_dup
from spanfeat.llm import shingles as sets
from spanfeat.llm.flat_text import flat
from spanfeat.llm.simhash_vp import fingerprint

SCHEMA = "doc_id long, text string, lang string"


def shingles(text):
    w = (text or "").split()
    return {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows_in):
    sets = [shingles(t) for _, t, _ in rows_in]
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or 9 * len(a & sets[j]) >= 4 * (len(a) + len(sets[j])) > 0:
                root = [root[j] if r == root[i] else r for r in root]
    groups = {}
    for r, row in zip(root, rows_in):
        groups.setdefault(r, []).append(row[0])
    return sorted(min((d for d in g if d is not None), default=-1) for g in groups.values())


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(5)
    made = []
    for base in range(12):
        text = [f"w{k}" for k in rng.integers(0, 3000, int(rng.integers(20, 500)))]
        for copy in range(6):
            edited = list(text)
            for k in rng.integers(0, len(text), int(len(text) * 0.008 * copy)):
                edited[k] = f"e{rng.integers(0, 10**6)}"
            made.append(" ".join(edited))
    made += ["", None, " \n", "one two", "one two", "ONE  two", "one three"]
    rows_in = [(k, t, "en") for k, t in enumerate(made)]
    return [rows_in[k] for k in rng.permutation(len(rows_in))] + rows_in[:3] + [(None, "only here", "en")]


def test_keeps_one_row_of_each_group(spark, corpus):
    got = corpus_pipeline.keep_one(spark, spark.createDataFrame(corpus, SCHEMA), "").collect()
    lower = [(d, t and t.lower(), x) for d, t, x in corpus]
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in got) == brute(lower)


def test_ordinary_edits_and_repeated_rows(spark):
    words = [f"w{k}" for k in np.random.default_rng(1).integers(0, 5000, 300)]
    edited = " ".join(w if k % 60 != 30 else f"x{k}" for k, w in enumerate(words))
    assert (fingerprint(" ".join(words)) ^ fingerprint(edited)).bit_count() > 3
    rows_in = [(2, edited, "en"), (1, " ".join(words), "en"), (1, " ".join(words), "en")]
    got = corpus_pipeline.keep_one(spark, spark.createDataFrame(rows_in, SCHEMA), "").collect()
    assert [tuple(r) for r in got] == [rows_in[1]]


def test_sets_against_plain_python():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["a", "B", "é", "cc", "x\ty", " "], rng.integers(0, 30))) for _ in range(300)] + [None, "", "  "]
    values, offsets = flat(pa.array(texts))
    h, row = sets.shingle_sets(values, offsets, 5)
    want = [{s for s in shingles((t or "").lower())} for t in texts]
    assert np.bincount(row, minlength=len(texts)).tolist() == [len(w) for w in want]
    everything = {}
    for k, t in enumerate(texts):  # equal shingles have equal hashes and others have others
        listed = sorted(want[k])
        for name, value in zip(listed, sorted(h[row == k].tolist())):
            everything.setdefault(frozenset(want[k]), set()).add(tuple(sorted(h[row == k].tolist())))
    assert all(len(v) == 1 for v in everything.values()) and len({v for vs in everything.values() for v in vs}) == len(everything)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, len(texts), (200, 2))]
    h1, r1 = sets.shingle_sets(*flat(pa.array([texts[a] for a, _ in pairs])), 5)
    h2, r2 = sets.shingle_sets(*flat(pa.array([texts[b] for _, b in pairs])), 5)
    assert sets.common_counts(h1, r1, h2, r2, len(pairs)).tolist() == [len(want[a] & want[b]) for a, b in pairs]


def test_pairs_at_the_bound_share_a_prefix():
    """Whatever the order, and within the reach that places and sizes allow."""
    rng = np.random.default_rng(2)
    for n in list(range(1, 60)) + [100, 333, 1000]:
        for _ in range(20):
            pool = rng.permutation(3 * n + 3)
            common = -(-4 * n // 5) if rng.random() < 0.5 else n
            a, b = pool[:n], pool[n - common : n - common + n]
            if common == n:
                b = pool[: n * 5 // 4]
            a, b = np.sort(a).tolist(), np.sort(b).tolist()
            if 9 * len(set(a) & set(b)) < 4 * (len(a) + len(b)):
                continue
            cut = lambda x: x[: len(x) - (4 * len(x) + 4) // 5 + 1]
            shared = set(cut(a)) & set(cut(b))
            assert any(9 * min(len(a) - a.index(s), len(b) - b.index(s)) >= 4 * (len(a) + len(b)) for s in shared)


def test_a_bucket_may_cross_batches(spark):
    cols = "sig long, salt int, id long, place int, size int"
    rows_in = [(k % 7, -1, k, 0, 9) for k in range(900)] + [(99, -1, 5, 0, 9), (100, -1, 6, 0, 9), (100, -1, 6, 0, 9)]
    rows_in += [(200, k % 3, k, 0, 9) for k in range(4)]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        got = near_dup.buckets(spark.createDataFrame(rows_in, cols)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = [(k % 7, -1, k, k % 7) for k in range(900)] + [(200, 0, 0, 0), (200, 0, 3, 0), (200, 1, 1, 1), (200, 2, 2, 2)]
    assert sorted((r["sig"], r["salt"], r["id"], r["first"]) for r in got) == sorted(want)


def test_boilerplate_makes_few_candidates(spark):
    """A thousand texts that share 20 of 26 words are no duplicates; their shared words link nothing."""
    rng = np.random.default_rng(4)
    shared = " ".join(f"common{k}" for k in range(20))
    rows_in = [(k, shared + " " + " ".join(f"w{x}" for x in rng.integers(0, 10**6, 6))) for k in range(1000)]
    texts = spark.createDataFrame(rows_in, "id long, text string")
    assert near_dup.buckets(near_dup.prefixes(texts, near_dup.frequencies(texts))).count() < 1000
    docs = texts.withColumnRenamed("id", "doc_id")
    assert near_dup.keep_first(docs).count() == 1000


def test_heavy_groups_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "HEAVY", 0.001)
    base = [f"w{k}" for k in range(60)]
    rows_in = [(k, " ".join([*base, f"z{k}"]), "x", 1, 2) for k in range(40)] + [(99, "another text of no group at all", "x", 1, 2)]
    docs = spark.createDataFrame(rows_in, "doc_id long, text string, n string, first int, _bad int")
    assert sorted(r.doc_id for r in near_dup.keep_first(docs).collect()) == [0, 99]
    assert near_dup.keep_first(docs).columns == docs.columns
    assert near_dup.keep_first(docs.limit(0)).count() == 0


def test_fingerprints_propose_pairs_before_the_exact_search(spark):
    """Texts within 3 bits meet through the fingerprints, and bits are majorities of the set."""
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in rng.integers(0, 9000, 900)]
    other = " ".join(f"v{k}" for k in rng.integers(0, 9000, 900))
    texts = spark.createDataFrame([(7, " ".join(words)), (3, " ".join([*words, "end"])), (5, other)], "id long, text string")
    assert [tuple(r) for r in near_dup.simhash_pairs(texts).collect()] == [(3, 7)]
    h, _ = sets.shingle_sets(*flat(pa.array([other])), near_dup.WIDTH)
    plain = sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h) > len(h))
    got = {r["id"]: r["fp"] % (1 << 64) for r in near_dup.fingerprints(texts).collect()}
    assert got[5] == plain and (got[3] ^ got[7]).bit_count() <= 3


def test_buckets_tell_pairs_that_cannot_be_near(spark):
    rows_in = [(1, -1, 1, 0, 100), (1, -1, 2, 0, 90), (1, -1, 3, 0, 60), (1, -1, 4, 30, 100)]
    got = near_dup.buckets(spark.createDataFrame(rows_in, "sig long, salt int, id long, place int, size int")).collect()
    assert {r["id"]: r["near"] for r in got} == {1: True, 2: True, 3: False, 4: False}


def test_large_groups_of_near_copies_are_not_paired_in_full(spark, monkeypatch):
    """Copies whose first does not link them all, and copies of it that are too far, are no square of pairs."""
    rng = np.random.default_rng(6)
    base = [f"w{k}" for k in range(150)]
    made = []
    for copy in range(300):
        edited = list(base)
        for k in rng.permutation(29)[: 2 + copy % 5]:
            edited[5 * k + 2] = f"e{copy}x{k}"
        made.append((copy, " ".join(edited), "en"))
    compared, plain = [], near_dup.confirm

    def counted(pairs, texts):
        compared.append(pairs.count())
        return plain(pairs, texts)

    monkeypatch.setattr(near_dup, "confirm", counted)
    got = near_dup.keep_first(spark.createDataFrame(made, SCHEMA)).collect()
    assert sorted(r.doc_id for r in got) == brute(made)
    assert sum(compared) < 10 * len(made)
