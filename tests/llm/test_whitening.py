"""Whitening against an eigendecomposition of the exact covariance."""

import math
from fractions import Fraction

import numpy as np
import pytest

from vigil.llm.common import table
from vigil.llm.whitening import components, deviations, dependent_factor, op12_whitening, solve, whiten, whole_vectors

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, n string, v string"


def exact(x):
    """Covariance in fractions, and centred rows."""
    n, d = len(x), len(x[0])
    mean = [Fraction(sum(int(r[k]) for r in x), n) for k in range(d)]
    away = [[int(r[k]) - mean[k] for k in range(d)] for r in x]
    cov = np.array([[float(sum(a[i] * a[j] for a in away) / n) for j in range(d)] for i in range(d)])
    return cov, np.array([[float(c) for c in a] for a in away])


def hold(rows, x, ids, most=32):
    cov, away = exact(x)
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    some = min(most, int((e > 1e-12 * e[0]).sum()))
    n = len(x)
    sums = [sum(int(r[k]) for r in x) for k in range(len(x[0]))]
    assert {len(r.whitened) for r in rows} == {some}
    key = lambda i, d: (str(i), d)      # noqa: E731
    want = sorted(((i, sum((n * int(c) - s) ** 2 for c, s in zip(r, sums, strict=True)), a) for i, r, a in zip(ids, x, away, strict=True)), key=lambda r: key(*r[:2]))
    got = sorted(rows, key=lambda r: key(r.vec_id, r.deviation))
    assert [(r.vec_id, r.deviation, r.n) for r in got] == [(i, d, n) for i, d, _ in want]
    white = np.array([r.whitened for r in got])
    ours = np.array([a for *_, a in want]) @ v[:, :some] / np.sqrt(e[:some])
    assert np.allclose(np.abs(white), np.abs(ours), atol=1e-7)
    assert np.allclose(white.T @ white / n, np.eye(some), atol=1e-9)
    assert np.allclose([r.explained for r in got], e[:some] / np.trace(cov), rtol=1e-9)
    assert {r.identity_error for r in got}.pop() < 1e-9


def whole(v):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]


def test_given_table(spark):
    rows = table(spark, SMALL, "embeddings").collect()
    hold(whiten(table(spark, SMALL, "embeddings")).collect(), [whole(r.embedding) for r in rows], [r.vec_id for r in rows])
    out = op12_whitening(spark, SMALL)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.count() == 32 * len(rows) and {r.component for r in out.select("component").distinct().collect()} == set(range(1, 33))


def test_odd_vectors(spark):
    """Null, null and non-finite entries, huge ones, other lengths; repeated rows and ids; dependent and constant dimensions; other columns."""
    rng = np.random.default_rng(5)
    good = [[float(np.float32(c)) for c in (a, b, a, 3.0, a + 2 * b, 1e-6 * c)] for a, b, c in rng.normal(size=(40, 3)) * [3, 1, 1]]
    good = [[*r[:4], r[0] * 16, r[5]] for r in good] + [good[0], good[0]]
    bad = [None, [], [1.0] * 5, [1.0] * 7, [None] + [1.0] * 5, [float("nan")] + [1.0] * 5, [float("inf")] + [1.0] * 5, [-3e38] + [1.0] * 5]
    ids = [i if i % 5 else None for i in range(len(good) - 1)] + [7]
    rows = [(i, v, "a", "b") for i, v in zip(ids, good, strict=True)] + [(100 + i, v, None, "b") for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    hold(whiten(df).collect(), [whole(v) for v in good], ids)
    assert len(whiten(df, most=2).first().whitened) == 2


@pytest.mark.parametrize("vectors", [[], [None], [[]], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [[float("nan")]]])
def test_no_variance(spark, vectors):
    assert whiten(spark.createDataFrame([(i, v, "", "") for i, v in enumerate(vectors)], SCHEMA)).count() == 0


def test_wide_spread_of_variances(spark):
    """Standard deviations from 40 to 4e6, turned so that no dimension shows them: small directions keep their digits."""
    rng = np.random.default_rng(1)
    turn, _ = np.linalg.qr(rng.normal(size=(5, 5)))
    x = rng.normal(size=(300, 5)) * [6e4, 6e3, 60.0, 6.0, 0.6] @ turn
    df = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    rows, d = whole_vectors(df, "vec_id", "embedding")
    n, _, matrix, e, share = components(rows, d, 32)
    got = np.array([r.whitened for r in whiten(df).collect()])
    assert n == 300 and len(e) == 5 and (np.diff(e) < 0).all()
    assert np.allclose(got.T @ got / n, np.eye(5), atol=1e-6)
    mean = np.array([math.floor(64 * c) for c in x.ravel()], float).reshape(x.shape)
    mean -= mean.mean(axis=0)
    assert np.allclose(np.sqrt(e * n), np.linalg.svd(mean, compute_uv=False), rtol=1e-6)


def test_exact_sums_beyond_a_long():
    x = np.array([[1_000_000, 2 ** 55]], np.int64)
    assert deviations(x, 10 ** 6, [5, 7]).tolist() == [[10 ** 12 - 5, 10 ** 6 * 2 ** 55 - 7]]


def test_dependent_columns_have_zero_rows():
    a = np.random.default_rng(2).normal(size=(50, 3))
    g = np.column_stack([a[:, 0], a[:, 0], a[:, 1], a[:, 0] - a[:, 1], a[:, 2]])
    r = dependent_factor(g.T @ g)
    assert np.allclose(r.T @ r, g.T @ g) and [k for k in range(5) if r[k, k] == 0] == [1, 3]
    q = g @ solve(r)
    assert np.allclose(q.T @ q, np.diag([1, 0, 1, 0, 1]), atol=1e-10)
