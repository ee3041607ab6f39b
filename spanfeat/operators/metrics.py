"""Classifier evaluation as distributed aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.checks import as_list, require_columns
from .ordering import ordered_prefix


def confusion(df: DataFrame, label: str, pred: str, classes: Sequence = (0, 1)) -> DataFrame:
    """Long confusion matrix (label, pred, n) with a row for every pair of classes."""
    require_columns(df, [label, pred])
    kind = df.schema[label].dataType.simpleString()
    grid = df.sparkSession.createDataFrame(
        [(a, b, 0) for a in classes for b in classes], f"label {kind}, pred {kind}, n long"
    )
    counts = df.groupBy(F.col(label).alias("label"), F.col(pred).cast(kind).alias("pred")).agg(
        F.count("*").alias("n")
    )
    return grid.unionByName(counts).groupBy("label", "pred").agg(F.sum("n").alias("n"))


def _ratio(top: Column, bottom: Column) -> Column:
    """Quotient, 0 for 0/0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def _harmonic(a: Column, b: Column) -> Column:
    return _ratio(2 * a * b, a + b)


def binary_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row: the four counts, accuracy, precision, recall and F1 of class 1."""
    truth, guess = F.col(label) == 1, F.col(pred) == 1
    counts = df.agg(
        F.count_if(truth & guess).alias("tp"),
        F.count_if(~truth & guess).alias("fp"),
        F.count_if(truth & ~guess).alias("fn"),
        F.count_if(~truth & ~guess).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "*",
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def class_report(df: DataFrame, label: str, pred: str, classes: Sequence = (0, 1)) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    Rows are named by the class, ``accuracy``, ``macro avg`` and ``weighted avg``; the
    accuracy row carries its value in ``f1``. Works on the k x k counts only.
    """
    cells = confusion(df, label, pred, classes)
    wide = cells.agg(
        F.sum("n").alias("_all"),
        F.sum(F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)).alias("_hit"),
        *[
            F.sum(F.when(test, F.col("n")).otherwise(0)).alias(f"_{name}{i}")
            for i, c in enumerate(classes)
            for name, test in (
                ("tp", (F.col("label") == F.lit(c)) & (F.col("pred") == F.lit(c))),
                ("of", F.col("label") == F.lit(c)),
                ("as", F.col("pred") == F.lit(c)),
            )
        ],
    )
    rows, per_class = [], []
    for i, c in enumerate(classes):
        precision = _ratio(F.col(f"_tp{i}"), F.col(f"_as{i}"))
        recall = _ratio(F.col(f"_tp{i}"), F.col(f"_of{i}"))
        per_class.append((precision, recall, _harmonic(precision, recall), F.col(f"_of{i}")))
        rows.append((F.lit(str(c)), *per_class[-1]))
    nothing = F.lit(None).cast("double")
    rows.append((F.lit("accuracy"), nothing, nothing, _ratio(F.col("_hit"), F.col("_all")), F.col("_all")))

    def averaged(weights: Sequence[Column], total: Column) -> list[Column]:
        return [
            _ratio(sum((m[j] * w for m, w in zip(per_class, weights, strict=True)), F.lit(0.0)), total)
            for j in range(3)
        ]

    ones = [F.lit(1.0) for _ in classes]
    rows.append((F.lit("macro avg"), *averaged(ones, F.lit(len(classes))), F.col("_all")))
    supports = [m[3] for m in per_class]
    rows.append((F.lit("weighted avg"), *averaged(supports, F.col("_all")), F.col("_all")))
    names = ("class", "precision", "recall", "f1", "support")
    return wide.select(
        F.inline(
            F.array(*[F.struct(*[v.alias(n) for n, v in zip(names, r, strict=True)]) for r in rows])
        )
    )


def _score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score."""
    return (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(
            F.count_if(F.col(label) == 1).alias("pos"),
            F.count_if(F.col(label) != 1).alias("neg"),
        )
    )


def auc_exact(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact areas under the ROC curve and under precision-recall (average precision).

    Tied scores count half for the ROC area. Rows shrink to distinct scores first;
    the global order over those is built in ranges, never in one task.
    """
    ranked = ordered_prefix(_score_counts(df, label, score), "score", ["pos", "neg"])
    totals = ranked.agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    at_or_above = F.col("_p") - F.col("pos_before")
    picked = at_or_above + F.col("_n") - F.col("neg_before")
    return (
        ranked.join(F.broadcast(totals))
        .agg(
            F.first("_p").alias("positives"),
            F.first("_n").alias("negatives"),
            F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2)).alias("_wins"),
            F.sum(F.col("pos") * _ratio(at_or_above, picked)).alias("_hits"),
        )
        .select(
            "positives",
            "negatives",
            F.try_divide(
                F.col("_wins"), F.col("positives").cast("double") * F.col("negatives")
            ).alias("auc_roc"),
            F.try_divide(F.col("_hits"), F.col("positives").cast("double")).alias("auc_pr"),
        )
    )


def roc_points(df: DataFrame, label: str, score: str, bins: int | None = None) -> DataFrame:
    """ROC curve as (threshold, tp, fp, tpr, fpr), one point per distinct score.

    With ``bins`` scores in [0, 1] are first floored to that many steps.
    """
    if bins:
        df = df.withColumn(score, F.floor(F.col(score) * bins) / bins)
    ranked = ordered_prefix(_score_counts(df, label, score), "score", ["pos", "neg"])
    totals = ranked.agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    tp = F.col("_p") - F.col("pos_before")
    fp = F.col("_n") - F.col("neg_before")
    return ranked.join(F.broadcast(totals)).select(
        F.col("score").alias("threshold"),
        tp.alias("tp"),
        fp.alias("fp"),
        _ratio(tp, F.col("_p")).alias("tpr"),
        _ratio(fp, F.col("_n")).alias("fpr"),
    )


def error_rate_by(df: DataFrame, label: str, pred: str, by: str | Sequence[str]) -> DataFrame:
    """Rows, false positives, false negatives and their shares per feature value."""
    truth, guess = F.col(label) == 1, F.col(pred) == 1
    return df.groupBy(*as_list(by)).agg(
        F.count("*").alias("n"),
        F.count_if(~truth & guess).alias("false_pos"),
        F.count_if(truth & ~guess).alias("false_neg"),
        (F.count_if(~truth & guess) / F.count("*")).alias("false_pos_share"),
        (F.count_if(truth & ~guess) / F.count("*")).alias("false_neg_share"),
    )
