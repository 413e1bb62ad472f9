from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrain.llm.whitening import jacobi_davidson, minres, whitened
from tests.conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows: list[tuple]) -> dict:
    """(vec_id, component) -> what the contract says, by a dense eigensolver."""
    good = [(i, v) for i, v in rows if v is not None and len(v)
            and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(256 * np.array([v for _, v in good], np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:4], u[:, ::-1][:, :4]
    real = e > 1e-12 * (centred**2).sum() / n
    out = {}
    for (i, _), row in zip(good, x, strict=True):
        deviation = sum((n * int(a) - int(b))**2 for a, b in zip(row, s, strict=True))
        for c in np.flatnonzero(real):
            w = (row - s / n) @ u[:, c] / np.sqrt(e[c])
            out.setdefault((i, int(c) + 1), []).append((n, deviation, w, e[c] / ((centred**2).sum() / n)))
    return out


def check(df, rows):
    truth = brute(rows)
    found: dict = {}
    for r in df.collect():
        assert r.identity_error <= 1e-9 and r.residual < 1e-12
        found.setdefault((r.vec_id, r.component), []).append((r.n, r.deviation, r.whitened, r.explained))
    assert {k: len(v) for k, v in found.items()} == {k: len(v) for k, v in truth.items()}
    for component in {c for _, c in truth}:
        keys = sorted((k for k in truth if k[1] == component), key=str)
        a = np.array([v[2] for k in keys for v in sorted(found[k])])
        b = np.array([v[2] for k in keys for v in sorted(truth[k])])
        sign = np.sign(a @ b)
        assert np.abs(a - sign * b).max() < 1e-8
        for k in keys:
            for one, two in zip(sorted(found[k]), sorted(truth[k]), strict=True):
                assert one[:2] == two[:2] and one[3] == pytest.approx(two[3], rel=1e-9)


def test_given_vectors(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    check(whitened(vectors), [(r.vec_id, r.embedding) for r in vectors.collect()])


def test_hard_rows(spark):
    pick = np.random.default_rng(3)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(pick.standard_normal((60, 6)).astype(np.float32))]
    rows += [rows[4]] * 30 + [(None, rows[5][1]), (100, None), (101, [1.0, None] + [0.0] * 4),
                              (102, [float("nan")] * 6), (103, [float("inf")] * 6), (104, []), (105, [0.0] * 6),
                              (106, [-0.0] * 6), (4, rows[9][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(3)
    clash = df.withColumns({c: F.lit("clash") for c in ("x", "n", "component", "i", "v", "d", "count", "whitened")})
    check(whitened(clash), rows)
    # Vectors of another length are not in the space.
    more = df.unionByName(spark.createDataFrame([(500, [1.0, 2.0], 1)], SCHEMA))
    check(whitened(more), rows)


@pytest.mark.parametrize("rows", [
    [(1, [0.5, 0.25]), (2, [0.5, 0.25])],                      # one point: nothing to whiten
    [(1, [0.5, 0.25, 0.0]), (2, [0.0, 0.25, 1.0]), (3, [0.5, 0.25, 0.0])],  # a line
    [(1, [0.5]), (2, [0.75]), (3, [7.0])],
    [(i, [300.0 * i, 5e4 * (i % 7)]) for i in range(40)],       # large numbers, exact deviation
])
def test_few_vectors(spark, rows):
    check(whitened(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)), rows)


def test_empty_table(spark):
    assert whitened(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("d", [1, 3, 40, 150])
def test_jacobi_davidson_against_a_dense_solver(d):
    pick = np.random.default_rng(d)
    basis, _ = np.linalg.qr(pick.standard_normal((d, d)))
    values = np.sort(pick.uniform(1, 2, d))[::-1] * np.where(np.arange(d) < 2, 5, 1)
    matrix = basis * values @ basis.T
    matrix = (matrix + matrix.T) / 2
    found, vectors, residual = jacobi_davidson(lambda q: matrix @ q, d, 4)
    assert residual < 1e-13 and np.allclose(found, values[:4], rtol=1e-13)
    assert np.allclose(vectors.T @ vectors, np.eye(min(4, d)), atol=1e-13)


def test_equal_eigenvalues_span_their_space():
    values = np.array([5.0, 5, 5, 2] + [1.0] * 30)
    found, vectors, _ = jacobi_davidson(lambda q: values[:, None] * q, 34, 4)
    assert np.allclose(found, values[:4]) and np.abs(vectors[4:]).max() < 1e-10


def test_minres_solves_the_correction_equation():
    pick = np.random.default_rng(0)
    a = pick.standard_normal((30, 30))
    a = a + a.T
    q, _ = np.linalg.qr(pick.standard_normal((30, 2)))
    right = pick.standard_normal((30, 2))
    right -= q @ (q.T @ right)
    shifts = np.array([0.3, -2.0])
    t = minres(lambda v: a @ v, shifts, q, right, 60, 1e-12)
    left = a @ t - shifts * t
    assert np.abs(q.T @ t).max() < 1e-12 and np.abs(left - q @ (q.T @ left) - right).max() < 1e-6
