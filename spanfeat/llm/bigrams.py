"""Word pairs of labelled texts, and their class-conditional Kneser-Ney ratios with shared backoff.

P(w | v) of a class is its discounted share of w among the words after v, plus what the
discounts leave, spread by the shared backoff: the share of w among the different pairs of
both classes together. All pairs are counted exactly and every pair of a text meets them.
Pairs travel packed, many to a row, to the bucket of their first word; frequent first words
have several buckets, dealt by the second word, so no task holds all pairs of one.
"""

from __future__ import annotations

import gc
import pickle
import time

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfeat.llm.flat_text import flat, parts
from spanfeat.llm.shingles import MARKS, mix, word_hashes
from spanfeat.session import staged

# Bytes of compressed text whose words are worked on at once.
PACKED = 1 << 19
# Bytes of text by bucket of pairs, and buckets at least.
BUCKET_BYTES, LEAST_BUCKETS = 16 << 20, 64
# Frequent first words, at most, and the buckets over which their pairs are dealt.
HOT, SALTS = 4_096, 64
# Texts meet the pairs in so many turns, so that only a part of their pairs is on disk at a time.
TURNS = 8

# Models: of the first fold, of the second, of both; each as the groups of its ordinary and toxic class.
MODELS = (((0,), (1,)), ((2,), (3,)), ((0, 2), (1, 3)))
_STATS = ("c", "n1", "n2", "n3", "n4", "more")  # words after v, pairs with counts 1 to 4, and with 3 or more


def discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """Kneser-Ney discounts for counts 1, 2 and 3 or more, from the numbers of cases with counts 1 to 4."""
    n = [max(1.0, v) for v in (n1, n2, n3, n4)]
    y = n[0] / (n[0] + 2 * n[1])
    return tuple(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.3), float(k)) for k in (1, 2, 3))


def freeze(*arrays: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, protocol=5))


def thaw(raw: bytes) -> tuple[np.ndarray, ...]:
    import zstandard

    return pickle.loads(zstandard.ZstdDecompressor().decompress(raw))


def _new(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted run of equal rows begins."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _pairs(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(v, w, row): every word with the word before it, 0 for the first of a text."""
    w, row = word_hashes(values, offsets, MARKS)
    v = np.zeros_like(w)
    v[1:] = np.where(row[1:] == row[:-1], w[:-1], np.uint64(0))
    return v, w, row


class Buckets:
    """Where pairs go, and in how many turns. The list of frequent words only spreads them; sums are the same with any."""

    def __init__(self, size: int, hot: np.ndarray):
        self.count, self.hot = max(LEAST_BUCKETS, size // BUCKET_BYTES), np.sort(hot)
        self.turns = max(1, min(TURNS, size // (BUCKET_BYTES // 4)))

    def is_hot(self, v: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(v), bool)
        return self.hot[np.minimum(np.searchsorted(self.hot, v), len(self.hot) - 1)] == v

    def of(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        home = mix(v + np.uint64(1)) % np.uint64(self.count)
        salt = np.where(self.is_hot(v), mix(w) % np.uint64(min(SALTS, self.count)), np.uint64(0))
        return ((home + salt) % np.uint64(self.count)).astype(np.int32)


def buckets(docs: DataFrame) -> Buckets:
    """Buckets for the size of the texts; the frequent words are those of a sixteenth of them."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def often(batches):
        for batch in batches:
            for part in parts(batch, "text"):
                words, times = np.unique(_pairs(*flat(part.column("text")))[0], return_counts=True)
                many = times * 5_000 >= times.sum()
                yield pa.RecordBatch.from_arrays([pa.array(words[many].view(np.int64)), pa.array(times[many])], names=["v", "k"])

    some = docs.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(16)) == 0)
    rows = some.mapInArrow(often, "v long, k long").groupBy("v").agg(F.sum("k").alias("k")).orderBy(F.desc("k"), "v").limit(HOT).collect()
    return Buckets(size, np.array([r["v"] for r in rows], np.int64).view(np.uint64))


def _by_bucket(p: np.ndarray, arrays: list[np.ndarray]):
    """Slices of arrays that are sorted by bucket, as (bucket, slices)."""
    at = np.flatnonzero(_new(p))
    for begin, end in zip(at, np.append(at[1:], len(p))):
        yield int(p[begin]), [a[begin:end] for a in arrays]


def _order(p: np.ndarray, v: np.ndarray) -> np.ndarray:
    """One number to sort by bucket and first word; rows of a word may, very rarely, be parted by another's."""
    return (p.astype(np.uint64) << np.uint64(44)) | (v >> np.uint64(20))


def _run_lengths(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(_new(v))
    return v[at], np.diff(np.append(at, len(v))).astype(np.uint32)


def _rows(made: list[tuple]) -> pa.RecordBatch:
    p, data = zip(*made)
    return pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(data, pa.binary())], names=["p", "data"])


def pair_counts(train: DataFrame, where: Buckets) -> DataFrame:
    """(p, data): per bucket its pairs as v, pairs of each v, w and the counts of the four groups, 2 * fold + toxic.

    ``train`` has fold (0 or 1), toxic and packed, the text compressed.
    """

    def count(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for part in parts(batch, "packed", PACKED):
                texts = pa.array([unpack(b) for b in part.column("packed").to_pylist()], pa.large_binary())
                v, w, row = _pairs(*flat(texts))
                if not len(w):
                    continue
                g = (part.column("fold").to_numpy() * 2 + part.column("toxic").to_numpy()).astype(np.uint8)[row]
                p = where.of(v, w)
                rank = np.lexsort(((w & ~np.uint64(3)) | g, _order(p, v)))
                at = np.flatnonzero(_new(p[rank], v[rank], w[rank], g[rank]))
                times = np.diff(np.append(at, len(rank))).astype(np.uint32)
                rank = rank[at]
                cut = _by_bucket(p[rank], [v[rank], w[rank], g[rank], times])
                yield _rows([(b, freeze(*_run_lengths(a[0]), *a[1:])) for b, a in cut])

    def add(key, pdf):
        found = [thaw(raw) for raw in pdf["data"]]
        v = np.concatenate([np.repeat(x[0], x[1]) for x in found])
        w, g, times = (np.concatenate([x[k] for x in found]) for k in (2, 3, 4))
        rank = np.lexsort((w, v))
        v, w, g, times = v[rank], w[rank], g[rank], times[rank]
        at = np.flatnonzero(_new(v, w))
        n = [np.add.reduceat(np.where(g == k, times, 0), at).astype(np.uint32) for k in range(4)]
        return pd.DataFrame({"p": [key[0]], "data": [freeze(*_run_lengths(v[at]), w[at], *n)]})

    made = train.mapInArrow(count, "p int, data binary").groupBy("p").applyInPandas(add, "p int, data binary")
    return staged(made, "pairs")


def _classes(n) -> list[np.ndarray]:
    """Counts of a pair by model and class, from those of the groups."""
    return [sum(n[g].astype(np.int64) for g in groups) for model in MODELS for groups in model]


def _summary(counts: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    """(model and class, statistic, v): see ``_STATS``; ``at`` is where the pairs of each v begin."""
    out = np.zeros((len(counts), len(_STATS), len(at)), np.int64)
    for m, c in enumerate(counts):
        for k, x in enumerate([c, c == 1, c == 2, c == 3, c == 4, c > 2]):
            out[m, k] = np.add.reduceat(x.astype(np.int64), at)
    return out


class Totals:
    """Of all pairs: discounts per model and class, and the statistics of frequent first words."""

    def __init__(self, pairs: DataFrame, where: Buckets):
        width = 2 * len(MODELS) * len(_STATS)
        names = [f"s{k}" for k in range(width)]

        def add(batches):
            for batch in batches:
                for raw in batch.column("data").to_pylist():
                    v, size, _, *n = thaw(raw)
                    stats = _summary(_classes(n), np.cumsum(size.astype(np.int64)) - size).reshape(width, -1)
                    hot = where.is_hot(v)
                    known = [None, *v[hot].view(np.int64).tolist()]
                    stats = np.column_stack([stats.sum(axis=1), stats[:, hot]])
                    yield pa.RecordBatch.from_arrays([pa.array(known, pa.int64()), *[pa.array(s) for s in stats]], names=["v", *names])

        made = pairs.mapInArrow(add, f"v long, {', '.join(f'{x} long' for x in names)}")
        rows = made.groupBy("v").agg(*[F.sum(x).alias(x) for x in names]).collect()  # at most HOT and one
        shape = (2 * len(MODELS), len(_STATS))
        whole = next((np.array(r[1:]).reshape(shape) for r in rows if r["v"] is None), np.zeros(shape))
        hot = sorted((np.int64(r["v"]).view(np.uint64), r[1:]) for r in rows if r["v"] is not None)
        self.hot = np.array([v for v, _ in hot], np.uint64)
        self.stats = np.array([s for _, s in hot], np.int64).reshape(len(hot), *shape).transpose(1, 2, 0)
        self.words = whole[:, 0]
        self.discounts = [discounts(*row[1:5]) for row in whole]

    def left(self, k: int, stats: np.ndarray) -> np.ndarray:
        """What the discounts leave of a word's followers; a class that lacks the word has the backoff alone."""
        total, n1, n2, _, _, more = stats[k]
        d = self.discounts[k]
        return np.where(total > 0, (d[0] * n1 + d[1] * n2 + d[2] * more) / np.maximum(total, 1), 1.0)

    def apart(self, m: int, stats: np.ndarray) -> np.ndarray:
        """Log-likelihood ratio, toxic to ordinary, of pairs that neither class has, by their first word."""
        if not self.words[2 * m] or not self.words[2 * m + 1]:
            return np.zeros(stats.shape[2])
        return np.log(self.left(2 * m + 1, stats)) - np.log(self.left(2 * m, stats))

    def of(self, v: np.ndarray, stats: np.ndarray) -> np.ndarray:
        """Statistics of words, of frequent ones over all their buckets."""
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, v), len(self.hot) - 1)
            same = self.hot[at] == v
            stats[:, :, same] = self.stats[:, :, at[same]]
        return stats


def word_counts(pairs: DataFrame) -> DataFrame:
    """(w, c0 to c3, u0 to u2, ps): different words before w by group, and by model for both classes; its buckets."""
    names = [*[f"c{g}" for g in range(4)], *[f"u{m}" for m in range(3)]]

    def count(batches):
        for batch in batches:
            for p, raw in zip(batch.column("p").to_pylist(), batch.column("data").to_pylist()):
                _, _, w, *n = thaw(raw)
                rank = np.argsort(w, kind="stable")
                at = np.flatnonzero(_new(w[rank]))
                held = [x > 0 for x in n] + [sum(n[g] for groups in model for g in groups) > 0 for model in MODELS]
                sums = [np.add.reduceat(h[rank].astype(np.int32), at, dtype=np.int32) for h in held]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w[rank][at].view(np.int64)), *[pa.array(s) for s in sums], pa.array(np.full(len(at), p, np.int32))],
                    names=["w", *names, "p"],
                )

    made = pairs.mapInArrow(count, f"w long, {', '.join(f'{x} int' for x in names)}, p int")
    return staged(made.groupBy("w").agg(*[F.sum(x).alias(x) for x in names], F.collect_list("p").alias("ps")), "words")


def with_backoff(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """(p, data): the pairs, each with u0 to u2 of its second word."""

    def reply(batches):
        for batch in batches:
            ps = batch.column("ps")
            p, at = ps.flatten().to_numpy(), np.repeat(np.arange(batch.num_rows), ps.value_lengths().to_numpy())
            rank = np.argsort(p, kind="stable")
            w = batch.column("w").to_numpy().view(np.uint64)
            u = [batch.column(f"u{m}").to_numpy().astype(np.uint32) for m in range(3)]
            cut = _by_bucket(p[rank], [x[at[rank]] for x in (w, *u)])
            if made := [(b, freeze(*a)) for b, a in cut]:
                yield _rows(made)

    def meet(key, left, right):
        v, size, w, *n = thaw(left["data"].iloc[0])
        found = [thaw(raw) for raw in right["data"]]
        known = np.concatenate([x[0] for x in found])
        rank = np.argsort(known)
        at = rank[np.searchsorted(known[rank], w)]
        u = [np.concatenate([x[m + 1] for x in found])[at] for m in range(3)]
        return pd.DataFrame({"p": [key[0]], "data": [freeze(v, size, w, *n, *u)]})

    replies = words.select("w", "u0", "u1", "u2", "ps").mapInArrow(reply, "p int, data binary")
    made = pairs.groupBy("p").cogroup(replies.groupBy("p")).applyInPandas(meet, "p int, data binary")
    return staged(made, "model")


def _logs(model: tuple, totals: Totals, m: int, spread: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood ratio, toxic to ordinary, of every pair, and of other pairs by their first word.

    ``spread`` is the number of different pairs of the model.
    """
    v, size, w, *n = model[:7]
    counts = _classes(n)
    stats = totals.of(v, _summary(counts, np.cumsum(size.astype(np.int64)) - size))
    apart = totals.apart(m, stats)
    ratio = np.repeat(apart, size)
    # a pair of the other fold alone is like one that neither class has
    held = counts[2 * m] + counts[2 * m + 1] > 0
    if totals.words[2 * m] and totals.words[2 * m + 1]:
        logs = []
        for k in (2 * m, 2 * m + 1):
            d, c = totals.discounts[k], counts[k][held]
            off = np.where(c > 2, d[2], np.where(c == 2, d[1], np.where(c == 1, d[0], 0.0)))
            seen, left = (np.repeat(x, size)[held] for x in (np.maximum(stats[k, 0], 1), totals.left(k, stats)))
            logs.append(np.log((c - off) / seen + left * (model[7 + m][held] / spread)))
        ratio[held] = logs[1] - logs[0]
    return ratio, apart


def _pair_hash(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(v * np.uint64(0x9E3779B97F4A7C15) + mix(w))


def _places(known: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where values stand in a list, or -1."""
    if not len(known):
        return np.full(len(asked), -1)
    rank = np.argsort(known)
    at = rank[np.minimum(np.searchsorted(known[rank], asked), len(known) - 1)]
    return np.where(known[at] == asked, at, -1)


def mean_ratios(docs: DataFrame, model: DataFrame, where: Buckets, totals: Totals, spread: list[int], models: tuple[int, ...]) -> DataFrame:
    """(key, r0 and so on): the mean log-likelihood ratio over all words of the texts with a key, per model asked for."""

    def deal(batches):
        for batch in batches:
            for part in parts(batch, "text"):
                v, w, row = _pairs(*flat(part.column("text")))
                if not len(w):
                    continue
                key = part.column("key").to_numpy()
                p = where.of(v, w)
                rank = np.argsort(_order(p, v))
                made = []
                for b, (v1, h1, r1) in _by_bucket(p[rank], [v[rank], _pair_hash(v, w)[rank], row[rank]]):
                    held = np.zeros(len(key), bool)
                    held[r1] = True
                    place = (np.cumsum(held) - 1)[r1].astype(np.uint32)
                    made.append((b, freeze(*_run_lengths(v1), h1, place, key[held])))
                yield _rows(made)

    sums = [f"s{m}" for m in models]

    def meet(p, left, right):
        found = [thaw(raw) for raw in left["data"]]
        if not found:
            return pd.DataFrame({"key": [], "k": [], **{s: [] for s in sums}})
        v, size, asked = (np.concatenate([x[k] for x in found]) for k in range(3))
        first = np.cumsum([0, *[len(x[4]) for x in found]])
        keys, to = np.unique(np.concatenate([x[4] for x in found]), return_inverse=True)
        to = to[np.concatenate([x[3] + at for x, at in zip(found, first)]).astype(np.int64)]
        out = {"key": keys, "k": np.bincount(to, minlength=len(keys))}
        known = thaw(right["data"].iloc[0]) if len(right) else None
        if known is not None:
            pair_at = _places(_pair_hash(np.repeat(known[0], known[1]), known[2]), asked)
            first_at = _places(known[0], v)
        hot_at = _places(totals.hot, v)
        for m, s in zip(models, sums):
            # pairs of frequent words have several buckets, some of them without the word
            value = np.where(hot_at >= 0, np.append(totals.apart(m, totals.stats), 0.0)[hot_at], 0.0)
            if known is None:
                value = np.repeat(value, size)
            else:
                pair, other = _logs(known, totals, m, spread[m])
                value = np.repeat(np.where(first_at >= 0, other[first_at], value), size)
                value = np.where(pair_at >= 0, pair[pair_at], value)
            out[s] = np.bincount(to, weights=value, minlength=len(keys))
        return pd.DataFrame(out)

    dealt = docs.select("key", "text").filter(F.length("text") > 0).mapInArrow(deal, "p int, data binary")
    schema = f"key long, k long, {', '.join(f'{s} double' for s in sums)}"
    made = dealt.groupBy("p").cogroup(model.groupBy("p")).applyInPandas(meet, schema)
    total = F.sum("k")
    return staged(made.groupBy("key").agg(*[(F.sum(s) / total).alias(f"r{s[1:]}") for s in sums]), "ratios")


def clean(spark: SparkSession) -> None:
    """Shuffle files go, in the background, once their plans are collected; a large job asks for that between its steps."""
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(0.5)
