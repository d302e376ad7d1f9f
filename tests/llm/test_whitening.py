"""Whitening against a dense eigendecomposition, and Jacobi-Davidson on hard spectra."""

import math
from fractions import Fraction

import numpy as np
import pytest

from plantlens.llm import whitening
from plantlens.llm.common import table
from plantlens.llm.queries import LLM_QUERIES


def dense(vectors, k=8):
    """n, sums, exact deviations, eigenvalues, vectors and trace."""
    x = np.floor(1024 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    away = n * x - sums
    centred = away / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    return n, sums, (away * away).sum(axis=1), e[::-1][:k], u[:, ::-1][:, :k], e.sum(), centred


def test_query(spark, sf_dir):
    source = {r.vec_id: r.embedding for r in table(spark, sf_dir, "embeddings").collect()}
    ids = sorted(source)
    n, _, deviation, e, u, trace, centred = dense([source[i] for i in ids])
    rows = LLM_QUERIES["op12_whitening"].run(spark, sf_dir).collect()
    assert len(rows) == 8 * len(ids) and {r.n for r in rows} == {n}
    found = {(r.vec_id, r.component): r for r in rows}
    errors = {r.identity_error for r in rows}
    assert len(errors) == 1 and errors.pop() < 1e-12
    for c in range(8):
        z = np.array([found[i, c + 1].whitened for i in ids])
        expected = centred @ u[:, c] / math.sqrt(e[c])
        sign = np.sign(z @ expected)
        assert np.abs(sign * z - expected).max() < 1e-10
        assert {found[i, c + 1].explained for i in ids} == {found[ids[0], c + 1].explained}
        assert math.isclose(found[ids[0], c + 1].explained, e[c] / trace, rel_tol=1e-12)
    assert [found[i, 1].deviation for i in ids] == deviation.tolist()


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("size", [1, 3, 8, 9, 30, 64, 200])
def test_spectra(size, seed):
    """Flat, steep, repeated and nearly equal eigenvalues, and low rank."""
    rng = np.random.default_rng(seed)
    spectrum = [
        np.ones(size) + 1e-3 * rng.random(size),
        10.0 ** -np.arange(size) if size < 12 else 0.5 ** np.arange(size),
        np.repeat(rng.random(size), 3)[:size],
        1 + 1e-9 * np.arange(size),
        np.r_[rng.random(min(3, size)), np.zeros(max(0, size - 3))],
        rng.random(size) ** 4,
    ][seed]
    q = np.linalg.qr(rng.standard_normal((size, size)))[0]
    a = (q * spectrum) @ q.T
    a = (a + a.T) / 2
    passes = [0]

    def apply(block):
        passes[0] += 1
        return a @ block

    vectors, values, residual = whitening.jacobi_davidson(apply, size, 8)
    expected = np.linalg.eigvalsh(a)[::-1][: min(8, size)]
    scale = expected[0]
    assert np.abs(values - expected).max() < 1e-12 * scale
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert passes[0] <= 200


def run(spark, rows, ddl="vec_id long, embedding array<double>"):
    df = spark.createDataFrame(rows, ddl)
    model = whitening.fit(df)
    return model, whitening.by_component(whitening.apply_whitening(df, model), model).collect()


def test_left_out_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.standard_normal(5).tolist()) for i in range(40)]
    bad = [(50, None), (51, [None] * 5), (52, [math.nan] + [0.0] * 4), (53, [math.inf] + [0.0] * 4)]
    bad += [(54, [-math.inf] * 5), (55, [1.0, 2.0]), (56, []), (57, [1e300] * 5)]
    twice = [(7, good[7][1]), (None, good[8][1])]
    model, rows = run(spark, good + bad + twice)
    assert model.n == 42 and {r.vec_id for r in rows} == {None, *range(40)}
    assert len(rows) == 42 * 5
    n, sums, deviation, e, u, trace, centred = dense([v for _, v in good + twice])
    assert list(model.sums) == sums.tolist()
    assert np.allclose(model.eigenvalues, e[:5], rtol=1e-12)
    assert sum(r.deviation for r in rows if r.component == 1) == deviation.sum()


def test_few_or_equal_vectors(spark):
    assert run(spark, [])[1] == []
    assert run(spark, [(1, None)])[1] == []
    assert run(spark, [(1, []), (2, [])])[1] == []
    model, rows = run(spark, [(i, [0.5, 0.25]) for i in range(9)])
    assert rows == [] and model.n == 9 and model.trace == 0
    model, rows = run(spark, [(1, [0.0, 0.0, 1.0]), (2, [0.0, 0.0, 3.0])])
    assert [r.component for r in rows] == [1, 1] and {abs(r.whitened) for r in rows} == {1.0}


def test_large_entries_are_exact(spark):
    values = [1e12, -3e12, 5.0, 7e11]
    model, rows = run(spark, [(i, [v, 1.0]) for i, v in enumerate(values)])
    x = [math.floor(1024 * v) + 100_000 for v in values]
    assert model.sums[0] == sum(x)
    exact = [(4 * v - sum(x)) ** 2 for v in x]
    found = {r.vec_id: r.deviation for r in rows}
    assert [found[i] for i in range(4)] == [v if v < 1 << 63 else None for v in exact]
    spread = math.sqrt(sum((Fraction(v) - Fraction(sum(x), 4)) ** 2 for v in x) / 4)
    assert math.isclose(math.sqrt(model.eigenvalues[0]), spread, rel_tol=1e-12)


def test_clashing_names(spark):
    rng = np.random.default_rng(2)
    ddl = "vec_id long, embedding array<float>, whitened string, n int, _vector int, component date, block int"
    rows = [(i, rng.standard_normal(3).tolist(), "w", 1, i, None, 2) for i in range(20)]
    model, found = run(spark, rows, ddl)
    assert len(found) == 60 and {r["_vector"] for r in found} == set(range(20))
    assert {r.n for r in found} == {20} and {r.block for r in found} == {2}


def test_sums_of_many_tasks(spark, monkeypatch):
    """Beyond the bound the tasks' parts are added up in groups first."""
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, rng.standard_normal(4).tolist()) for i in range(64)], "vec_id long, embedding array<double>")
    whole = whitening.fit(df)
    monkeypatch.setattr(whitening, "PARTIAL_BYTES", 200)
    monkeypatch.setattr(whitening, "TASK_BYTES", 256)
    parted = whitening.fit(df.repartition(8))
    assert np.allclose(whole.eigenvalues, parted.eigenvalues, rtol=1e-12)
    assert parted.identity_error < 1e-12
