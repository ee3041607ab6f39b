"""Whitening against dense eigenvectors, and its parts against NumPy."""

import numpy as np
import pytest

from spanfeat.llm import whitening as w


def square(a):
    a = a - a.mean(axis=0)
    r = np.linalg.qr(a, mode="r")
    return a, np.vstack([r, np.zeros((a.shape[1] - len(r), a.shape[1]))])


def check(a, count=16, rel=1e-12):
    a, r = square(a)
    squares, v = w.principal(r, min(count, a.shape[1]))
    s = np.linalg.svd(a, compute_uv=False)
    k = len(squares)
    assert k == min(count, int((s > s[0] * 1e-12).sum()))
    assert np.abs(squares / s[:k] ** 2 - 1).max(initial=0) < rel
    assert np.abs(v.T @ v - np.eye(k)).max(initial=0) < 1e-11
    assert np.abs(a.T @ (a @ v) - v * squares).max(initial=0) < 1e-13 * max(s[0] ** 2, 1) * len(r)


def test_solver_on_hard_spectra():
    rng = np.random.default_rng(4)
    turn = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    check(rng.standard_normal((400, 64)))
    check((rng.standard_normal((300, 30)) * 3.0 ** -np.arange(30)) @ turn, rel=1e-6)
    check(rng.standard_normal((300, 5)) @ rng.standard_normal((5, 40)))
    check(np.vstack([np.eye(30), -np.eye(30)]) @ turn)  # one eigenvalue thirty times
    repeated = np.diag(np.repeat([5.0, 3.0, 1.0], 10))
    check(np.vstack([repeated, -repeated]) @ turn)
    check(rng.standard_normal((40, 1)))
    check(rng.integers(-9, 9, (5, 40)).astype(float))


def test_solver_on_small_whole_numbers():
    rng = np.random.default_rng(5)
    for _ in range(150):
        a, r = square(rng.integers(-3, 4, (rng.integers(1, 30), rng.integers(1, 20))).astype(float))
        squares, v = w.principal(r, a.shape[1])
        s = np.linalg.svd(a, compute_uv=False)
        assert len(squares) == int((s > 1e-9).sum())
        assert np.allclose(squares, s[: len(squares)] ** 2, rtol=1e-9)
        assert np.allclose(v.T @ v, np.eye(len(squares)), atol=1e-8)


def test_dqds_keeps_small_values():
    values = np.sqrt(w.dqds(np.array([1.0, 1e-8, 1e-16]), np.array([1e-3, 1e-12])))
    exact = np.linalg.svd(np.array([[1, 1e-3, 0], [0, 1e-8, 1e-12], [0, 0, 1e-16]]), compute_uv=False)
    assert np.allclose(values[:2], exact[:2], rtol=1e-12)
    assert np.isclose(np.prod(values), 1e-24, rtol=1e-12)  # the determinant


SCHEMA = "vec_id long, embedding array<float>, x int, n long"


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(6)
    base = (rng.standard_normal((300, 24)) * np.linspace(1, 0.2, 24)).astype(np.float32)
    made = [(k, v.tolist(), 1, 2) for k, v in enumerate(base)]
    made += [(400 + k, base[0].tolist(), 1, 2) for k in range(150)]  # a third of all rows
    made += [(900, None, 1, 2), (901, [None] + [0.0] * 23, 1, 2), (902, [float("nan")] * 24, 1, 2)]
    made += [(903, [float("inf")] * 24, 1, 2), (904, [], 1, 2), (None, base[1].tolist(), 1, 2)]
    return made


def test_against_dense_eigenvectors(spark, vectors):
    got = w.whiten(spark.createDataFrame(vectors, SCHEMA).repartition(7)).toPandas()
    good = [(i, v) for i, v, *_ in vectors if v and None not in v and np.isfinite(v).all()]
    x = {i: np.floor(64 * np.array(v, float)).astype(int) + 1_000_000 for i, v in good}
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    e, vec = np.linalg.eigh(centred.T @ centred / n)
    e, vec = e[::-1], vec[:, ::-1]
    assert len(got) == 16 * len(good) and (got["n"] == n).all()
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9
    for k in range(16):
        part = got[got["component"] == k + 1].sort_values("vec_id", na_position="last")
        order = sorted(x, key=lambda i: (i is None, i))
        want = np.array([(n * x[i] - sums) / n @ vec[:, k] / np.sqrt(e[k]) for i in order])
        have = part["whitened"].to_numpy()
        assert np.allclose(have * np.sign(have @ want), want, atol=1e-9)
        assert np.allclose(part["explained"], e[k] / e.sum(), rtol=1e-9)
        assert part["deviation"].tolist() == [sum((int(n) * int(a) - int(s)) ** 2 for a, s in zip(x[i], sums)) for i in order]


def test_many_small_blocks(spark):
    rng = np.random.default_rng(8)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.standard_normal((200, 6)))]
    one = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = w.scaled(one).select("x").distinct().repartition(60)
    fit = np.array([r[0] for r in got.collect()])
    r = w.triangle(got, len(fit), fit.sum(axis=0))
    centred = fit - fit.mean(axis=0)
    assert np.allclose(r.T @ r, centred.T @ centred)


def test_few_alike_empty_and_mixed(spark):
    assert w.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    alike = spark.createDataFrame([(k, [0.5, 0.25], 1, 2) for k in range(5)], SCHEMA)
    assert w.whiten(alike).count() == 0
    two = spark.createDataFrame([(1, [0.0, 0.0], 1, 2), (2, [1.0, 0.0], 1, 2)], SCHEMA)
    got = w.whiten(two).toPandas()
    assert len(got) == 2 and np.allclose(sorted(got["whitened"]), [-1, 1]) and (got["explained"] == 1).all()
    mixed = spark.createDataFrame([(1, [0.0, 0.0], 1, 2), (2, [1.0], 1, 2)], SCHEMA)
    with pytest.raises(ValueError, match="1 to 2 entries"):
        w.whiten(mixed)


def test_exact_deviation_beyond_doubles(spark):
    far = [(k, [float(1 << (20 + k % 3)), float(k)]) for k in range(6)]
    df = spark.createDataFrame(far, "vec_id long, embedding array<double>")
    got = {(r["vec_id"]): r["deviation"] for r in w.whiten(df).collect()}
    x = [[64 * int(c) + 1_000_000 for c in v] for _, v in far]
    sums = [sum(c) for c in zip(*x)]
    assert got == {k: sum((6 * a - s) ** 2 for a, s in zip(x[k], sums)) for k in range(6)}
