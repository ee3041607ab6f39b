"""Weighted logistic regression by Newton steps on distributed normal equations.

Each step is one pass: every task adds up X'WX, X'Wr and the loss over its rows, the sums
are merged in two levels, and the driver solves a system as large as the number of features.
Numbers are standardised in the rows. One-hot columns stay sparse: their products are counts
by code, and their standardisation is a change of basis on the driver, whose shift goes into
the intercept.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.checks import require_columns
from ..session import staged
from .gramian import sum_arrays

# Categories in all; their list and a matrix of their number squared reach the driver.
MAX_LEVELS = 5_000


@dataclass(frozen=True)
class LogitModel:
    """Fitted weights on the original scale; ``standardized`` holds those of the solved system."""

    intercept: float
    numeric: Mapping[str, float]
    levels: Mapping[str, Mapping[str, float]]
    standardized: Mapping[str, float]
    steps: int
    change: float

    def margin(self) -> Column:
        """Log-odds as a column expression; a category unseen in training adds nothing."""
        parts: list[Column] = [F.lit(self.intercept)]
        parts += [F.lit(w) * F.col(c).cast("double") for c, w in self.numeric.items()]
        for c, by_level in self.levels.items():
            pairs = [F.lit(x) for level in by_level.items() for x in level]
            if pairs:
                parts.append(F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(c).cast("string")), F.lit(0.0)))
        return reduce(lambda a, b: a + b, parts)

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.margin()))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the columns prediction and probability, as classifiers of Spark ML give them."""
        return df.withColumn("_p", self.probability()).select(
            *df.columns,
            array_to_vector(F.array(1 - F.col("_p"), F.col("_p"))).alias("probability"),
            (F.col("_p") > 0.5).cast("double").alias("prediction"),
        )

    def coefficients(self, df: DataFrame) -> DataFrame:
        """(slot, coefficient) on the standardised scale, one row per feature."""
        return df.sparkSession.createDataFrame(list(self.standardized.items()), "slot string, coefficient double")


def _levels(rows: DataFrame, categorical: Sequence[str]) -> dict[str, dict[str, int]]:
    """Values of each category (columns c0, c1 and so on), sorted, with their rows; nulls are no level."""
    if not categorical:
        return {}
    named = F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"c{i}").alias("v")) for i, c in enumerate(categorical)])
    counts = rows.select(F.explode(named).alias("r")).select("r.*").filter("v IS NOT NULL").groupBy("c", "v").count()
    found = counts.limit(MAX_LEVELS + 1).collect()
    if len(found) > MAX_LEVELS:
        raise ValueError(f"more than {MAX_LEVELS} categories")
    return {c: {r["v"]: r["count"] for r in sorted(found, key=lambda r: r["v"]) if r["c"] == c} for c in categorical}


def fit_logit(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str,
    weight: str | None = None,
    reg: float = 0.0,
    tol: float = 1e-6,
    max_steps: int = 50,
) -> LogitModel:
    """Minimise the weighted mean loss plus ``reg`` / 2 times the squared standardised weights.

    All features are standardised by the mean and sample deviation of ``df``, one-hot columns
    as well; constant ones get weight 0. Steps are halved while the loss rises. Raises
    RuntimeError if the last step still exceeds ``tol`` after ``max_steps`` passes (Newton
    steps end in errors of about the square of the last one), and ValueError for rows with a missing number, label or weight.
    """
    require_columns(df, [*numeric, *categorical, label, *([weight] if weight else [])])
    named = {f"x{i}": F.col(c).cast("double") for i, c in enumerate(numeric)}
    rows = df.select(
        *[e.alias(n) for n, e in named.items()],
        *[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(categorical)],
        F.col(label).cast("double").alias("y"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
    )
    rows = staged(rows, "logit")
    levels = _levels(rows, categorical)
    needed = [*named, "y", "w"]
    bad = F.count_if(reduce(lambda a, b: a | b, [F.col(c).isNull() | F.isnan(c) for c in needed]))
    head = rows.agg(
        F.count("*").alias("n"), bad.alias("bad"), F.sum("w").alias("w"),
        *[f(c).alias(f"{name}_{c}") for c in named for name, f in (("mean", F.avg), ("sd", F.stddev))],
    ).first()
    if head["bad"]:
        raise ValueError(f"{head['bad']} rows lack a number, label or weight")
    n, mass = head["n"], head["w"]
    if not n or not mass:
        raise ValueError("no rows to fit")
    mean = np.array([head[f"mean_{c}"] for c in named])
    sd = np.array([head[f"sd_{c}"] or 0.0 for c in named])
    safe = np.where(sd > 0, sd, 1.0)
    sizes = [len(levels[c]) for c in categorical]
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(int) + 1 + len(named)
    k, numbers = int(starts[-1]), list(named)
    sets = [pa.array(list(levels[c]), pa.string()) for c in categorical]

    def sums(beta: np.ndarray) -> np.ndarray:
        """Products of the raw design, residual products and loss at weights of the raw design."""

        def fold(batches):
            h, g, loss = np.zeros((k, k)), np.zeros(k), np.zeros(1)
            for batch in batches:
                if not batch.num_rows:
                    continue
                y, w = (batch.column(c).to_numpy() for c in ("y", "w"))
                z = [np.ones(len(y))]
                z += [(batch.column(c).to_numpy() - mean[i]) / safe[i] for i, c in enumerate(numbers)]
                z = np.stack(z, axis=1)
                codes = [
                    pc.fill_null(pc.index_in(batch.column(f"c{i}"), value_set=s), -1).to_numpy(zero_copy_only=False)
                    for i, s in enumerate(sets)
                ]
                d = z.shape[1]
                eta = z @ beta[:d]
                for code, at in zip(codes, starts):
                    eta += np.where(code >= 0, beta[at + code], 0.0)
                p = 1 / (1 + np.exp(-eta))
                curve = w * p * (1 - p)
                r = w * (y - p)
                loss[0] += (w * (np.logaddexp(0, eta) - y * eta)).sum()
                h[:d, :d] += z.T @ (z * curve[:, None])
                g[:d] += z.T @ r
                for i, (code, at) in enumerate(zip(codes, starts)):
                    size, has = sizes[i], code >= 0
                    c, cw = code[has], curve[has]
                    cols = slice(at, at + size)
                    for j in range(d):
                        h[j, cols] += np.bincount(c, weights=cw * z[has, j], minlength=size)
                    g[cols] += np.bincount(c, weights=r[has], minlength=size)
                    h[range(at, at + size), range(at, at + size)] += np.bincount(c, weights=cw, minlength=size)
                    for j in range(i):
                        both = has & (codes[j] >= 0)
                        cross = np.bincount(codes[j][both] * size + code[both], weights=curve[both], minlength=sizes[j] * size)
                        h[starts[j] : starts[j] + sizes[j], cols] += cross.reshape(sizes[j], size)
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([h.ravel(), g, loss]).tobytes()])], names=["m"])

        return sum_arrays(rows.mapInArrow(fold, "m binary"))

    # one-hot column (raw - share) / deviation, as a change of basis of the raw design
    basis = np.eye(k)
    basis[range(1, 1 + len(named)), range(1, 1 + len(named))] = sd > 0
    held = [count for c in categorical for count in levels[c].values()]
    for at, count in enumerate(held, start=1 + len(named)):
        share = count / n
        spread = np.sqrt(share * (1 - share) * n / (n - 1)) if n > 1 else 0.0
        basis[:, at] = 0.0
        if spread > 0:
            basis[at, at], basis[0, at] = 1 / spread, -share / spread
    ridge = np.full(k, reg)
    ridge[0] = 0.0

    def evaluate(beta: np.ndarray):
        flat = sums(basis @ beta)
        h = flat[: k * k].reshape(k, k)
        h = np.triu(h) + np.triu(h, 1).T
        loss = flat[-1] / mass + (ridge * beta * beta).sum() / 2
        return basis.T @ h @ basis / mass + np.diag(ridge), basis.T @ flat[k * k : -1] / mass - ridge * beta, loss

    beta = np.zeros(k)
    h, g, loss = evaluate(beta)
    passes, change = 1, np.inf
    while passes < max_steps:
        step = np.linalg.lstsq(h, g, rcond=1e-13)[0]
        change = float(np.abs(step).max(initial=0.0))
        if change < tol:  # the last step is taken as well: what is left is about its square
            beta = beta + step
            break
        made = evaluate(beta + step)
        passes += 1
        while made[2] > loss + 1e-12 * abs(loss) and passes < max_steps:
            step /= 2
            made = evaluate(beta + step)
            passes += 1
        beta, (h, g, loss) = beta + step, made
    if change >= tol:
        raise RuntimeError(f"no convergence in {max_steps} passes: the last step was {change:.3g}")
    raw = basis @ beta
    weights = raw[1 : 1 + len(named)] / safe
    slots = ["(intercept)", *numeric, *[f"{c}_vec_{v}" for c in categorical for v in levels[c]]]
    return LogitModel(
        float(raw[0] - (weights * mean).sum()),
        {c: float(v) for c, v in zip(numeric, weights)},
        {c: {v: float(raw[starts[i] + j]) for j, v in enumerate(levels[c])} for i, c in enumerate(categorical)},
        {s: float(v) for s, v in zip(slots, beta)},
        passes,
        change,
    )
