"""Whitening of embeddings: blockwise QR, bidiagonal form, dqds and twisted factorisations.

The tasks reduce the centred rows to one upper triangle by QR, block by block and then
triangle by triangle. What is left is as small as the square of the vectors' length: the
triangle is brought to bidiagonal form by Householder reflections, dqds steps find its
singular values to high relative accuracy, and twisted factorisations of the tridiagonal
product give the directions. Nothing squares the rows, so small variances keep their digits
beside a large mean.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanfeat.llm.common import release
from spanfeat.session import staged

EPS = np.finfo(float).eps
# An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
# Triangles that one task reduces to one.
FAN_IN = 16


def bidiagonalize(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor V with r = U B V' for a square matrix r."""
    a = np.array(r, float)
    d = len(a)
    v = np.eye(d)

    def reflector(x):
        """u and beta such that (I - beta u u') x points along the first axis."""
        u = x.copy()
        norm = np.linalg.norm(x)
        if norm == 0 or not np.any(x[1:]):
            return u, 0.0
        u[0] += np.copysign(norm, x[0])
        return u, 2.0 / (u @ u)

    for k in range(d):
        u, beta = reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(u, u @ a[k:, k:])
        if k + 2 < d:
            u, beta = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ u, u)
            v[:, k + 1 :] -= beta * np.outer(v[:, k + 1 :] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential quotient-difference step; None where the shift was too large."""
    d, nq, ne = q[0] - shift, [], []
    for k in range(len(e)):
        if d < 0:
            return None
        top = d + e[k]
        if top == 0:
            return None
        ratio = q[k + 1] / top
        nq.append(top)
        ne.append(e[k] * ratio)
        d = d * ratio - shift
    if d < 0:
        return None
    return [*nq, d], ne


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, largest first.

    Works on the squares q and e of the entries by subtraction-free steps, each shifted by a
    bound that is lowered until all numbers stay positive; a value splits off where its
    neighbour e no longer changes it.
    """
    tiny = float(np.finfo(float).tiny)
    out: list[float] = []
    work = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    while work:
        q, e, moved = work.pop()
        for _ in range(60 * len(q) + 60):
            if not q:
                break
            if len(q) == 1:
                out.append(q[0] + moved)
                q = []
                break
            # negligible couplings part the array
            cut = [k for k in range(len(e)) if e[k] <= EPS * EPS * (moved + min(q[k], q[k + 1])) or e[k] <= tiny]
            if cut:
                at = 0
                for k in [*cut, len(e)]:
                    work.append((q[at : k + 1], e[at:k], moved))
                    at = k + 1
                q = []
                break
            if 1.5 * q[0] < q[-1]:  # small values converge at the end
                q, e = q[::-1], e[::-1]
            # smaller eigenvalue of the last two by two, an upper bound of the smallest
            a = q[-2] + (e[-2] if len(e) > 1 else 0.0)
            b, off = q[-1] + e[-1], q[-2] * e[-1]
            half = (a - b) / 2
            low = b - off / (half + np.copysign(np.hypot(half, off**0.5), half)) if off else min(a, b)
            shift = max(0.0, min(low, q[-1]) * (1 - 4 * EPS))
            made = None
            for factor in (1.0, 0.75, 0.25, 0.0):
                made = _dqds_step(q, e, shift * factor)
                if made is not None:
                    moved += shift * factor
                    break
            if made is None:  # an exact zero on the diagonal
                q = [max(x, EPS * EPS * max(q), tiny) for x in q]
                continue
            q, e = made
        if q:
            raise ArithmeticError("singular values did not converge")
    return np.sort(np.array(out))[::-1]


def _twisted(d: np.ndarray, l: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Eigenvectors of L D L' for well separated eigenvalues, one column each.

    From the top the stationary and from the bottom the progressive transform factor
    L D L' - value; they meet at the row where the twist is smallest, and from there the
    vector is the product of multipliers in both directions.
    """
    n, m = len(d), len(values)
    floor = EPS * np.maximum(np.abs(values), EPS * d.max(initial=0.0)) + np.finfo(float).tiny

    def safe(x):
        return np.where(np.abs(x) < floor * EPS, np.where(x < 0, -floor, floor) * EPS, x)

    s, p = np.empty((n, m)), np.empty((n, m))
    down, up = np.empty((n, m)), np.empty((n, m))
    s[0] = -values
    for k in range(n - 1):
        plus = safe(s[k] + d[k])
        down[k] = d[k] * l[k] / plus
        s[k + 1] = down[k] * l[k] * s[k] - values
    p[-1] = d[-1] - values
    for k in range(n - 2, -1, -1):
        minus = safe(d[k] * l[k] ** 2 + p[k + 1])
        ratio = d[k] / minus
        up[k] = l[k] * ratio
        p[k] = p[k + 1] * ratio - values
    gamma = s + p + values
    twist = np.argmin(np.abs(gamma), axis=0)
    z = np.zeros((n, m))
    z[twist, np.arange(m)] = 1.0
    for k in range(n - 2, -1, -1):
        z[k] = np.where(k < twist, -down[k] * z[k + 1], z[k])
    for k in range(n - 1):
        z[k + 1] = np.where(k >= twist, -up[k] * z[k], z[k + 1])
    return z / np.linalg.norm(z, axis=0)


def _settle_cluster(t_diag: np.ndarray, t_off: np.ndarray, z: np.ndarray, value: float) -> np.ndarray:
    """Orthonormal vectors for eigenvalues too close to part: inverse iteration on all at once."""
    n = len(t_diag)
    t = np.diag(t_diag - value * (1 + 4 * EPS)) + np.diag(t_off, 1) + np.diag(t_off, -1)
    basis = z + 1e-3 * np.random.default_rng(0).standard_normal(z.shape)
    for _ in range(4):
        basis, _ = np.linalg.qr(basis)
        basis = np.linalg.solve(t + EPS * abs(value) * np.eye(n), basis)
    basis, _ = np.linalg.qr(basis)
    ritz = basis.T @ (t @ basis)
    order = np.argsort(np.linalg.eigvalsh(ritz))
    turn = np.linalg.eigh((ritz + ritz.T) / 2)[1]
    return basis @ turn[:, order[::-1]]


def right_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest squared singular values and their right vectors of a bidiagonal matrix."""
    n = len(diagonal)
    scale = float(np.sqrt(values[0])) if len(values) else 0.0
    small = np.abs(above) <= EPS * (np.abs(diagonal[:-1]) + np.abs(diagonal[1:])) * 0.5
    borders = [0, *(np.flatnonzero(small) + 1).tolist(), n]
    found = []
    for lo, hi in zip(borders, borders[1:]):
        a = diagonal[lo:hi].copy()
        a = np.where(np.abs(a) < EPS * scale, EPS * scale, a)
        b = above[lo : hi - 1]
        own = dqds(a, b)[:count]
        d, l = a * a, b / a[:-1]
        z = _twisted(d, l, own)
        t_diag = d.copy()
        t_diag[1:] += b * b
        first = 0
        for k in range(1, len(own) + 1):  # runs of eigenvalues closer than a millionth
            if k < len(own) and own[k - 1] - own[k] <= 1e-6 * own[k - 1]:
                continue
            if k - first > 1:
                z[:, first:k] = _settle_cluster(t_diag, a[:-1] * b, z[:, first:k], float(own[first:k].mean()))
            first = k
        for k in range(len(own)):
            full = np.zeros(n)
            full[lo:hi] = z[:, k]
            found.append((own[k], full))
    found.sort(key=lambda f: -f[0])
    found = found[:count]
    return np.array([f[0] for f in found]), np.array([f[1] for f in found]).T.reshape(n, len(found))


def principal(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest squared singular values and right singular vectors of a triangle, without those that are nought."""
    diagonal, above, v = bidiagonalize(r)
    values = dqds(diagonal, above)
    keep = int((values[:count] > values[:1] * (8 * len(r) * EPS) ** 2).sum())
    if not keep:
        return np.empty(0), np.empty((len(r), 0))
    squares, z = right_vectors(diagonal, above, values, keep)
    return squares, v @ z


def scaled(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x): whole-number vectors of the rows whose entries are all there and finite."""
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = embeddings.select(F.col("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).filter(~bad)
    return rows.select("vec_id", F.transform("embedding", lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def triangle(fit: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """Triangle R with R'R = sum of the centred rows' outer products."""
    d = len(sums)

    def reduce_rows(batches):
        r = np.zeros((0, d))
        for batch in batches:
            centred = (n * matrix(batch.column("x")) - sums) / n
            r = np.linalg.qr(np.vstack([r, centred]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(r).tobytes()])], names=["r"])

    def merge(key, pdf):
        stack = np.vstack([np.frombuffer(b).reshape(-1, d) for b in pdf["r"]])
        return pd.DataFrame({"r": [np.ascontiguousarray(np.linalg.qr(stack, mode="r")).tobytes()]})

    level = staged(fit.mapInArrow(reduce_rows, "r binary"), "triangles")
    while (count := level.count()) > 1:  # one row per task, then a sixteenth at each level
        groups = -(-count // FAN_IN)
        numbered = level.withColumn("g", F.pmod(F.xxhash64("r"), F.lit(groups)))
        above = staged(numbered.groupBy("g").applyInPandas(merge, "r binary"), "triangles")
        release(level)
        level = above
    r = np.frombuffer(level.first()["r"]).reshape(-1, d)
    release(level)
    return np.vstack([r, np.zeros((d - len(r), d))]) if len(r) < d else r


class Whitening:
    """Fitted directions: n, sums per dimension, directions, variances, explained shares."""

    def __init__(self, n: int, sums: np.ndarray, r: np.ndarray, components: int):
        self.n, self.sums = n, sums
        squares, self.directions = principal(r, components)
        self.variances = squares / n
        total = float((r * r).sum()) / n
        self.explained = self.variances / total if total else self.variances
        self.scale = self.directions / np.sqrt(self.variances)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, in whole numbers."""
        return self.n * x - self.sums

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) / self.n @ self.scale


def fit_whitening(vectors: DataFrame, components: int = 16) -> tuple[Whitening, float] | None:
    """Fit on each distinct ``x`` once; also the identity error measured over that list.

    Returns None for an empty list. Vectors of several lengths raise ValueError.
    """
    fit = staged(vectors.select("x").distinct(), "fit")
    head = fit.agg(F.count("*").alias("n"), F.min(F.size("x")).alias("lo"), F.max(F.size("x")).alias("hi")).first()
    if not head["n"]:
        return None
    if head["lo"] != head["hi"]:
        raise ValueError(f"vectors have {head['lo']} to {head['hi']} entries")

    def add(batches):
        total = 0
        for batch in batches:
            total = total + matrix(batch.column("x")).sum(axis=0)
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["k", "s"])

    # one row per dimension
    sums = fit.mapInArrow(add, "k long, s long").groupBy("k").agg(F.sum("s").alias("s")).orderBy("k").toPandas()
    model = Whitening(head["n"], sums["s"].to_numpy(np.int64), triangle(fit, head["n"], sums["s"].to_numpy(np.int64)), components)
    k = len(model.variances)

    def products(batches):
        total = np.zeros((k, k))
        for batch in batches:
            y = model.apply(matrix(batch.column("x")))
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(total.ravel())], names=["k", "s"])

    error = 0.0
    if k:
        # k * k rows
        cov = fit.mapInArrow(products, "k long, s double").groupBy("k").agg(F.sum("s").alias("s")).orderBy("k").toPandas()
        error = float(np.abs(cov["s"].to_numpy().reshape(k, k) / model.n - np.eye(k)).max())
    release(fit)
    return model, error


def whiten(embeddings: DataFrame, components: int = 16) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error).

    One row per remaining row and component. Rows whose vector is null, or holds null or
    non-finite entries, go; empty vectors have no component. Equal vectors are fitted once
    and returned as often as given. Directions without variance are no components: vectors
    that are all alike give no rows, as does an empty table. Extra columns are ignored;
    vectors of several lengths raise ValueError, and so does a deviation beyond 64 bits.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    vectors = scaled(embeddings)
    fitted = fit_whitening(vectors, components)
    if fitted is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    model, error = fitted
    k = len(model.variances)

    def deviations(x: np.ndarray) -> np.ndarray:
        wide = model.centred(x)
        if float(np.abs(wide).max(initial=0)) ** 2 * wide.shape[1] < 2.0**62:
            return (wide * wide).sum(axis=1)
        exact = [sum(v * v for v in row) for row in wide.tolist()]
        if max(exact) >= 1 << 63:
            raise ValueError("a deviation does not fit in 64 bits")
        return np.array(exact, np.int64)

    def run(batches):
        for batch in batches:
            x = matrix(batch.column("x"))
            rows = len(x)
            if not rows or not k:
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, model.n, np.int64)),
                    pa.array(np.repeat(deviations(x), k)),
                    pa.array(model.apply(x).ravel()),
                    pa.array(np.tile(model.explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(run, schema)
