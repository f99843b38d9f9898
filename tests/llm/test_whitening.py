"""FEAST components and whitened rows against numpy's dense eigenvectors; sums against Python's integers."""

import numpy as np
import pytest

from changefold.llm import whitening as w


def dense(entries, wanted=32):
    x = np.floor(64 * np.asarray(entries, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    v = (x - s / n).T @ (x - s / n) / n
    value, vectors = np.linalg.eigh(v)
    order = np.argsort(value)[::-1][:wanted]
    order = [k for k in order if value[k] > 1e-9 * value.max()]
    exact = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
    return n, exact, (x - s / n) @ vectors[:, order] / np.sqrt(value[order]), value[order] / np.trace(v)


def frame(spark, rows, extra=False):
    schema = "vec_id long, embedding array<float>" + (", component int, _id string, n long, label int" if extra else "")
    return spark.createDataFrame([(*r, 7, "x", 1, 0) if extra else r for r in rows], schema)


def compared(out, entries, wanted=32):
    n, exact, whitened, explained = dense(entries, wanted)
    got = sorted(out.collect(), key=lambda r: (r.vec_id, r.component))
    k = whitened.shape[1]
    assert len(got) == n * k and [r.component for r in got[:k]] == list(range(1, k + 1))
    assert {r.n for r in got} == {n} and [r.deviation for r in got[::k]] == exact
    assert np.allclose([r.explained for r in got[:k]], explained, rtol=1e-6)
    mine = np.array([r.whitened for r in got]).reshape(n, k)
    sign = np.sign((mine * whitened).sum(0))
    assert np.abs(mine * sign - whitened).max() < 1e-6
    assert max(r.identity_error for r in got) < 1e-6
    return mine


def test_against_dense(spark):
    rng = np.random.default_rng(1)
    entries = (rng.standard_normal((300, 40)) @ rng.standard_normal((40, 40)) + rng.standard_normal(40) * 50).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(entries)]
    compared(w.whiten(frame(spark, rows, extra=True)), entries)


def test_damaged_rows_go_and_repeats_count(spark):
    entries = [[1.0, 2.0, 3.5], [2.0, -1.0, 0.25], [0.5, 4.0, 1.0], [0.5, 4.0, 1.0], [7.0, 0.0, 2.0]]
    rows = [(i, v) for i, v in enumerate(entries)]
    rows += [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [float("nan"), 1.0, 2.0]), (94, [float("inf"), 1.0, 2.0]), (95, [1.0, 2.0]), (96, [3e38, 0.0, 0.0])]
    compared(w.whiten(frame(spark, rows)), entries)


def test_null_id_is_a_row(spark):
    out = w.whiten(frame(spark, [(None, [1.0, 0.0]), (1, [0.0, 3.0]), (2, [2.0, 2.0])])).collect()
    assert len(out) == 6 and sum(r.vec_id is None for r in out) == 2


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_nothing_to_whiten(spark, rows):
    assert w.whiten(frame(spark, rows)).collect() == []


def test_dimension_without_variance_has_no_component(spark):
    out = w.whiten(frame(spark, [(1, [1.0, 5.0]), (2, [2.0, 5.0]), (3, [4.0, 5.0])])).collect()
    assert {r.component for r in out} == {1} and abs(out[0].explained - 1) < 1e-12


@pytest.mark.parametrize("values", [np.linspace(1, 9, 50), np.repeat([5.0, 1.0], 25), np.r_[np.full(20, 3.0), np.linspace(0, 1, 30)], 10.0 ** -np.arange(12), np.r_[7.0, 7.0 - 1e-9, 1.0]])
def test_components_of_known_spectra(spark, values):
    """Wide, repeated, clustered and steep spectra: none is missed, vectors are orthonormal, residuals are rounding."""
    d = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    value, vectors = w.components(spark, a)
    true = np.sort(values)[::-1][: len(value)]
    assert len(value) == min(32, (values > d * 2**-52 * values.max()).sum())
    assert np.abs(value - true).max() < 1e-12 * values.max()
    assert np.abs(vectors.T @ vectors - np.eye(len(value))).max() < 1e-12
    assert np.abs(a @ vectors - vectors * value).max() < 1e-12 * values.max()


def test_inertia_counts():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((30, 30))
    a += a.T
    values = np.linalg.eigvalsh(a)
    at = rng.uniform(values[0], values[-1], 20)
    assert (w.above(*w.tridiagonal(a), at) == (values[None] > at[:, None]).sum(1)).all()
    assert np.abs(w.located(*w.tridiagonal(a)) - values[::-1]).max() < 1e-10


@pytest.mark.parametrize("size", [10, 1 << 30, 1 << 40])
def test_products_are_exact(size):
    v = np.random.default_rng(4).integers(-size, size, (50, 3))
    assert (w.products(v) == np.array([[sum(int(x) * int(y) for x, y in zip(v[:, i], v[:, j], strict=True)) for j in range(3)] for i in range(3)], dtype=object)).all()
