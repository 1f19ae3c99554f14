"""Whitening against numpy's eigenvectors and plain sums."""

import math

import numpy as np
import pytest

from footfall.llm import whitening as W

SCHEMA = "vec_id bigint, embedding array<double>, length string, x string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], SCHEMA)


def integers(vector):
    return tuple(math.floor(64 * c) + 1_000_000 for c in vector)


def check(spark, rows, components=16):
    usable = [(i, integers(v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    got = W.whitened(frame(spark, rows), components=components).collect()
    want_rows = 0
    for length in {len(x) for _, x in usable}:
        fit = np.array(sorted({x for _, x in usable if len(x) == length}))
        n, total = len(fit), [sum(map(int, column)) for column in fit.T]
        centred = fit - fit.mean(axis=0)
        values, vectors = np.linalg.eigh(centred.T @ centred / n)
        values, vectors = values[::-1], vectors.T[::-1]
        many = min(components, int((values > 1e-9 * max(values[0], 1e-300)).sum()))
        for i, x in usable:
            if len(x) != length:
                continue
            want_rows += many
            deviation = sum((n * int(a) - s) ** 2 for a, s in zip(x, total))
            own = [r for r in got if r.vec_id == i and r.deviation == deviation and r.n == n]
            assert {r.component for r in own} == set(range(1, many + 1))
            for r in own:
                k = r.component - 1
                assert r.explained == pytest.approx(values[k] / values.sum(), rel=1e-9)
                assert r.identity_error < 1e-9
                gaps = np.abs(np.delete(values, k) - values[k])
                if gaps.min() > 1e-6 * values[0]:
                    want = (np.array(x) - fit.mean(axis=0)) @ vectors[k] / np.sqrt(values[k])
                    assert abs(r.whitened) == pytest.approx(abs(want), rel=1e-6, abs=1e-6)
    assert len(got) == want_rows
    return got


def test_rows_of_several_kinds(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(20) * np.linspace(1, 0.05, 20)).tolist()) for i in range(120)]
    rows += [(200, rows[3][1]), (3, rows[3][1]), (None, rows[4][1])]
    rows += [(300, None), (301, [1.0, None] * 10), (302, [float("nan")] * 20), (303, [math.inf] * 20), (304, [])]
    rows += [(400 + i, rng.standard_normal(3).tolist()) for i in range(9)] + [(500, [0.25] * 7)]
    check(spark, rows)


def test_equal_eigenvalues_and_low_rank(spark):
    corners = [(i, [float(i >> b & 1) for b in range(5)] + [0.0, 0.0]) for i in range(32)]
    got = check(spark, corners)  # five equal eigenvalues, two that are zero
    matrix = np.array([[r.whitened for r in got if r.component == k] for k in range(1, 6)])
    assert np.allclose(matrix @ matrix.T / 32, np.eye(5), atol=1e-9)


def test_large_entries_and_empty_tables(spark):
    rows = [(1, [1e4, 3e2]), (2, [-2e4, 5e2]), (3, [7.5e3, -1e2]), (4, [1.0, 1.0])]
    check(spark, rows)
    huge = W.whitened(frame(spark, [(1, [1e300, 0.0]), (2, [0.0, 1.0]), (3, [2.0, 3.0])])).collect()
    assert len(huge) == 3 * len({r.component for r in huge}) and all(np.isfinite(r.whitened) for r in huge)
    assert any(r.deviation is None for r in huge)
    assert W.whitened(frame(spark, [])).count() == 0
    assert W.whitened(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).count() == 0


def test_eigenvalues_and_vectors_are_those_of_numpy():
    rng = np.random.default_rng(1)
    cases = [np.diag([3.0, 3.0, 3.0, 1.0]), np.ones((6, 6)), np.eye(40), np.array([[2.0]])]
    for n in (2, 3, 30, 96):
        a = rng.standard_normal((n, 2 * n))
        cases += [a @ a.T, a[:, : n // 2 + 1] @ a[:, : n // 2 + 1].T]
    for matrix in cases:
        values, vectors = W.leading_components(matrix, 16)
        want = np.linalg.eigvalsh(matrix)[::-1]
        many = min(16, int((want > len(matrix) * 1e-13 * want[0]).sum()))
        assert len(values) >= many and np.allclose(values, want[: len(values)], rtol=1e-12, atol=1e-12 * want[0])
        assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-12)
        assert np.allclose(matrix @ vectors.T, vectors.T * values, atol=1e-11 * want[0])


def test_sturm_counts():
    rng = np.random.default_rng(7)
    diagonal, off = rng.standard_normal(30), rng.standard_normal(29)
    off[11] = 0.0
    values = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1))
    at = np.concatenate([values - 1e-9, values + 1e-9])
    assert W.sturm_counts(diagonal, off, at).tolist() == (values[None, :] < at[:, None]).sum(axis=1).tolist()
