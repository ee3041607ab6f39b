"""Pair ratios against a plain Kneser-Ney on a small corpus."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spanfeat.llm import bigrams, toxicity

N = 60


def corpus():
    rng = random.Random(4)
    words = [f"w{k}" for k in range(25)]
    rows = []
    for k in range(N):
        text = rng.choices(words, [1 / (1 + j) for j in range(25)], k=rng.randint(1, 40))
        if k % 3 == 0:
            text = [w for w in text for w in ([w, "mud"] if w == "w3" else [w])]
        rows.append((k, " ".join(text), int(k % 3 == 0), k % 2))
    return rows


def spans(text):
    words = re.findall("[a-z0-9]+", text)
    return list(zip([None, *words], words))


def plain(rows, folds):
    """Ratio of a pair by the definition."""
    seen = [Counter(p for _, text, toxic, fold in rows if toxic == k and fold in folds for p in spans(text)) for k in (0, 1)]
    different = set(seen[0]) | set(seen[1])
    ways = Counter(w for _, w in different)

    def share(k, v, w):
        after = {b: c for (a, b), c in seen[k].items() if a == v}
        backoff = ways[w] / len(different) if w in ways else 1.0  # any, as it cancels
        if not after:
            return backoff
        d = (0.0, *bigrams.discounts(*(sum(c == j for c in seen[k].values()) for j in (1, 2, 3, 4))))
        left = sum(d[min(c, 3)] for c in after.values())
        c = after.get(w, 0)
        return (c - d[min(c, 3)] + left * backoff) / sum(after.values())

    return lambda v, w: math.log(share(1, v, w)) - math.log(share(0, v, w))


@pytest.mark.parametrize("hot", [0, 6])
def test_mean_ratio_of_all_words(spark, monkeypatch, hot):
    monkeypatch.setattr(bigrams, "HOT", max(hot, 1))
    rows = corpus()
    docs = spark.createDataFrame([(k, t) for k, t, _, _ in rows], "doc_id long, text string")
    known = spark.createDataFrame([(k, toxic, fold) for k, _, toxic, fold in rows if toxicity_fold(k) != 1], "doc_id long, toxic int, fold int")
    where = bigrams.buckets(docs)
    if hot:
        where.hot = bigrams.np.sort(bigrams._pairs(*bigrams.flat(bigrams.pa.array(["w0 w1 w2 w3 mud w0"])))[0])
    pairs = bigrams.pair_counts(toxicity.training_texts(docs, known), where)
    words = bigrams.word_counts(pairs)
    totals = bigrams.Totals(pairs, where)
    spread = list(words.agg(*[F.sum(f"u{m}") for m in range(3)]).first())
    model = bigrams.with_backoff(pairs, words)
    extra = [(100, "w0 new w1"), (101, "new newer"), (102, "w3 mud mud"), (103, ""), (104, None), (105, "W0 w1"), (105, "W0 w1")]
    texts = spark.createDataFrame([(k, t) for k, t, _, _ in rows] + extra, "key long, text string")
    got = {r["key"]: r for r in bigrams.mean_ratios(texts, model, where, totals, spread, (0, 1, 2)).collect()}
    trained = [r for r in rows if toxicity_fold(r[0]) != 1]
    for m, folds in enumerate([(0,), (1,), (0, 1)]):
        ratio = plain(trained, folds)
        for key, text in [(k, t) for k, t, _, _ in rows] + extra:
            if text:
                each = [ratio(*p) for p in spans(text.lower())]
                assert got[key][f"r{m}"] == pytest.approx(sum(each) / len(each), abs=1e-9)
    assert not {103, 104} & set(got)


def toxicity_fold(k):
    import zlib

    return zlib.crc32(str(k).encode()) % 3


def test_pairs_decide_where_words_do_not(spark):
    """Both classes have the same words after the same number of different words, in other pairs."""
    rng = random.Random(1)
    turns = {0: [("a", "b"), ("c", "d")], 1: [("a", "d"), ("c", "b")]}
    rows = []
    for k in range(300):
        text = [w for _ in range(30) for w in rng.choice(turns[k % 2])]
        rows.append((k, " ".join(text), k % 2))
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    out = toxicity.toxicity(docs, labels).filter("held_out").collect()
    assert sum(r["predicted"] == r["doc_id"] % 2 for r in out) >= 0.95 * len(out)
