"""Toxicity from two class-conditional Kneser-Ney models with shared backoff.

Every word of a text is judged by the word before it: its log-likelihood ratio, toxic to
ordinary, is that of the pair (see ``bigrams``). The score calibrates the length-normalised
sum over all words, beside summaries of the words that speak for themselves: a word's weight
in a class is the number of different words it follows there (Kneser-Ney's continuation
count), discounted and interpolated with the counts of both classes together, and in these
summaries words below ``EVIDENCE`` count as even. All counts are exact, live in tables that
grow with the corpus and meet the documents in joins.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanfeat.llm.bigrams import Totals, buckets, clean, discounts, mean_ratios, pair_counts, with_backoff, word_counts
from spanfeat.llm.common import release
from spanfeat.llm.flat_text import flat, parts
from spanfeat.llm.shingles import MARKS, slots, word_hashes
from spanfeat.session import staged

# Log-likelihood ratio (natural) from which a word is evidence.
EVIDENCE = 2.5
# Bits of the filter that documents' words pass before they are joined to the evidence. Its
# size bounds what is sent to tasks; words that pass wrongly find no partner in the join.
FILTER_BITS = 1 << 24
# Labelled rows for the calibration of scores, at most.
CALIBRATION_ROWS = 20_000


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id's text modulo 3; rows with 1 are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


# Models: of the first fold, of the second, of both; each as the counts of its ordinary and toxic class.
MODELS = (("c0", "c1"), ("c2", "c3"), ("c0 + c2", "c1 + c3"))


def ratios(counts: DataFrame) -> list[Column] | None:
    """Per model the log-likelihood ratio of a word, toxic to ordinary; None where a class is empty."""
    sums = []
    for m, classes in enumerate(MODELS):
        for k, c in enumerate(classes):
            c = F.expr(c)
            sums.append(F.coalesce(F.sum(c), F.lit(0)).alias(f"n{m}{k}"))
            sums += [F.count_if(c == j).alias(f"n{m}{k}{j}") for j in (1, 2, 3, 4)]
            sums.append(F.count_if(c > 2).alias(f"n{m}{k}5"))
    row = counts.agg(*sums).first()
    out = []
    for m, classes in enumerate(MODELS):
        total = [row[f"n{m}{k}"] for k in (0, 1)]
        if not all(total):
            out.append(None)
            continue
        shared = (F.expr(classes[0]) + F.expr(classes[1])) / float(sum(total))
        logs = []
        for k, c in enumerate(classes):
            c = F.expr(c)
            d = discounts(*(row[f"n{m}{k}{j}"] for j in (1, 2, 3, 4)))
            spare = (d[0] * row[f"n{m}{k}1"] + d[1] * row[f"n{m}{k}2"] + d[2] * row[f"n{m}{k}5"]) / total[k]
            off = F.when(c == 0, 0.0).when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])
            logs.append(F.log((c - off) / float(total[k]) + spare * shared))
        # a word of the other fold alone has no counts here and is even
        out.append(F.when(shared > 0, logs[1] - logs[0]).otherwise(0.0))
    return None if out[2] is None else out


def evidence_words(counts: DataFrame) -> DataFrame | None:
    """(w, e0, e1, e2): per model how far a word's ratio exceeds ``EVIDENCE``, where any does."""
    made = ratios(counts)
    if made is None:
        return None
    excess = [
        (F.lit(0.0) if r is None else F.greatest(r - EVIDENCE, F.lit(0.0))).alias(f"e{m}") for m, r in enumerate(made)
    ]
    return counts.select("w", *excess).filter("e0 > 0 OR e1 > 0 OR e2 > 0")


def word_filter(words: DataFrame) -> np.ndarray:
    """Bits of all words, as ``FILTER_BITS`` / 8 bytes; they reach the driver in pieces that tasks have merged."""
    step = FILTER_BITS // 8 // 64

    def fill(batches):
        bits = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            bits[slots(batch.column("w").to_numpy().view(np.uint64), FILTER_BITS)] = True
        packed = np.packbits(bits)
        for k in range(0, len(packed), step):
            if packed[k : k + step].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([packed[k : k + step].tobytes()])], names=["k", "b"]
                )

    def merge(key, pdf):
        total = np.zeros(step, np.uint8)
        for raw in pdf["b"]:
            total |= np.frombuffer(raw, np.uint8)
        return pd.DataFrame({"k": [key[0]], "b": [total.tobytes()]})

    table = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in words.select("w").mapInArrow(fill, "k int, b binary").groupBy("k").applyInPandas(merge, "k int, b binary").collect():
        table[row["k"] : row["k"] + step] = np.frombuffer(row["b"], np.uint8)
    return table


def matches(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """(doc_id, key, n, hits, row): words of each text, and those that pass the filter, once with their number."""
    shared = docs.sparkSession.sparkContext.broadcast(table)  # FILTER_BITS bits

    def scan(batches):
        bits = shared.value
        for batch in batches:
            for part in parts(batch, "text"):
                w, row = word_hashes(*flat(part.column("text")), MARKS)
                at = slots(w, FILTER_BITS)
                found = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
                h, r = w[found], row[found]
                rank = np.lexsort((h, r))
                h, r = h[rank], r[rank]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(h)))
                ends = np.concatenate([[0], np.cumsum(np.bincount(r[first], minlength=part.num_rows))])
                pairs = pa.StructArray.from_arrays(
                    [pa.array(h[first].view(np.int64)), pa.array(times.astype(np.int32))], names=["w", "k"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("key"), pa.array(np.bincount(row, minlength=part.num_rows).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs),
                    ],
                    names=["doc_id", "key", "n", "hits"],
                )

    made = docs.select("doc_id", "key", "text").mapInArrow(scan, "doc_id long, key long, n long, hits array<struct<w: long, k: int>>")
    return staged(made.withColumn("row", F.monotonically_increasing_id()), "matches")


def features(excess: Column, mean: Column) -> list[Column]:
    """Length-normalised summaries of the sum of excess ratios (per word, its root, per root of the length), and the mean ratio of all words."""
    n = F.greatest(F.col("n"), F.lit(1)).cast("double")
    return [excess / n, F.sqrt(excess / n), excess / F.sqrt(n), mean]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps, halved while the loss rises: mean, scale and coefficients."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    b = np.zeros(z.shape[1])
    ridge = np.append(0.0, np.full(x.shape[1], 0.1))

    def loss(b):
        return (np.logaddexp(0, z @ b) - y * (z @ b)).sum() + (ridge * b * b).sum() / 2

    now = loss(b)
    for _ in range(100):
        p = 1 / (1 + np.exp(-z @ b))
        curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge) + 1e-9 * np.eye(len(b))
        step = np.linalg.solve(curve, z.T @ (y - p) - ridge * b)
        while (made := loss(b + step)) > now and np.abs(step).max() > 1e-10:
            step = step / 2
        b, now = b + step, min(made, now)
        if np.abs(step).max() < 1e-8:
            break
    return np.vstack([np.append(0, mean), np.append(1, scale), b])


def training_texts(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(fold, toxic, packed) of the labelled rows outside the held-out fold; texts travel compressed.

    The labels grow with the texts, so they are never broadcast: the join is the same at all
    sizes. A filter of fixed size keeps most texts without a label out of it.
    """
    table = word_filter(known.select(F.xxhash64("doc_id").alias("w")))
    shared = docs.sparkSession.sparkContext.broadcast(table)  # FILTER_BITS bits

    def squeeze(batches):
        import zstandard

        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            at = slots(batch.column("at").to_numpy().view(np.uint64), FILTER_BITS)
            batch = batch.filter(pa.array((shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0))
            for part in parts(batch, "text"):
                packed = [packer.compress((t or "").encode()) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "packed"])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = ids.withColumn("at", F.xxhash64("doc_id")).filter((fold_of(F.col("doc_id")) != 1) & (F.length("text") > 0))
    return texts.mapInArrow(squeeze, "doc_id long, packed binary").join(known.hint("merge"), "doc_id").select("fold", "toxic", "packed")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``.

    Null, empty and wordless texts have no evidence and a mean ratio of 0; where the labels do not show both classes every text scores 0.5. Several labels of one
    document: the largest counts. Null labels and other values than 0 and 1 are ignored. A
    null doc_id is scored and not held out. Extra columns are ignored; an empty table gives
    no rows. The two folds outside the held-out one score each other for the calibration, so
    that it never sees a model of its own text; at most ``CALIBRATION_ROWS`` rows calibrate,
    and everything else covers all rows.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("fold", (fold_of(F.col("doc_id")) / 2).cast("int")).filter(fold_of(F.col("doc_id")) != 1)
    spark = docs.sparkSession
    where = buckets(docs)
    pairs = pair_counts(training_texts(docs, known), where)
    clean(spark)
    counts = word_counts(pairs)
    clean(spark)
    evidence = evidence_words(counts)
    held = F.coalesce(fold_of(F.col("doc_id")) == 1, F.lit(False)).alias("held_out")
    if evidence is not None:
        totals = Totals(pairs, where)
        spread = list(counts.agg(*[F.sum(f"u{m}") for m in range(3)]).first())
        evidence = staged(evidence, "evidence")
        model = with_backoff(pairs, counts)
        release(pairs, counts)
        clean(spark)
        # rows that agree in id and text have one key
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("key", F.xxhash64("doc_id", "text"))
        found = matches(texts, word_filter(evidence))
        hits = found.select("row", F.explode("hits").alias("h")).select("row", "h.w", "h.k")
        sums = hits.join(evidence, "w").groupBy("row").agg(*[F.sum(F.col("k") * F.col(f"e{m}")).alias(f"s{m}") for m in range(3)])
        sums = staged(found.drop("hits").join(sums, "row", "left").na.fill(0.0, ["s0", "s1", "s2"]), "sums")
        release(evidence, found)
        clean(spark)
        sample = staged(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(CALIBRATION_ROWS), "sample")
        turns = []
        for turn in range(where.turns):
            some = texts.filter(F.pmod("key", F.lit(where.turns)) == turn)
            turns.append(mean_ratios(some, model, where, totals, spread, (2,)))
            clean(spark)
        some = texts.join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi")
        apart = mean_ratios(some, model, where, totals, spread, (0, 1))
        release(model)
        clean(spark)
        sums = sums.join(reduce(DataFrame.unionByName, turns), "key", "left").na.fill(0.0, ["r2"])
        other = [F.when(F.col("fold") == 0, F.col(f"{x}1")).otherwise(F.col(f"{x}0")) for x in ("s", "r")]
        rows = sums.filter("n > 0").join(F.broadcast(sample), "doc_id").join(apart, "key")
        fit = rows.select("toxic", *[f.alias(f"f{k}") for k, f in enumerate(features(*other))]).toPandas()
        release(apart, sample)
        if fit["toxic"].nunique() == 2:
            mean, scale, b = _logistic(fit[["f0", "f1", "f2", "f3"]].to_numpy(), fit["toxic"].to_numpy())
            z = F.lit(float(b[0]))
            for k, f in enumerate(features(F.col("s2"), F.col("r2"))):
                z = z + (f - float(mean[k + 1])) * float(b[k + 1] / scale[k + 1])
            score = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
            scored = sums.select("doc_id", held, score.alias("score"))
            return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, F.lit(0.5).alias("score"))
    return plain.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
