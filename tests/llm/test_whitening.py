"""Whitening against numpy's eigendecomposition over whole numbers kept in Python."""

import math
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluicegate.llm import whitening

KIND = "vec_id long, embedding array<double>, n int, _id string, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", "b") for i, v in rows], KIND).repartition(3)


def plain(rows, size):
    """Brute force: fit list, n, sums, eigenvalues and eigenvectors of its covariance."""
    good = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    sums = [sum(column) for column in zip(*fit)]
    n = len(fit)
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return good, n, sums, values[::-1], vectors[:, ::-1]


def compare(rows, got, size):
    good, n, sums, values, vectors = plain(rows, size)
    k = min(4, int((values > 1e-9 * values[0]).sum()))
    assert len(got) == k * len(good)
    by = defaultdict(list)
    for r in got:
        by[r.component].append(r)
        assert r.n == n and 0 <= r.identity_error <= 1e-6
    for c in range(1, k + 1):
        want = sorted(
            (i, sum((n * a - s) ** 2 for a, s in zip(x, sums)), float(np.dot([(n * a - s) / n for a, s in zip(x, sums)], vectors[:, c - 1]) / math.sqrt(values[c - 1])))
            for i, x in good
        )
        have = sorted((r.vec_id, r.deviation, r.whitened) for r in by[c])
        assert [w[:2] for w in want] == [h[:2] for h in have]
        a, b = np.array([w[2] for w in want]), np.array([h[2] for h in have])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6
        assert all(abs(r.explained - values[c - 1] / values.sum()) < 1e-9 for r in by[c])


def test_whole_table(spark, small):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    compare(rows, whitening.op13_embedding_whitening(spark, small).collect(), len(rows[0][1]))


def test_hard_rows(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, [1e6 + float(a), -1e6 + 3 * float(b), 0.01 * float(a), 5.0, float(c)]) for i, (a, b, c) in enumerate(rnd.normal(size=(300, 3)))]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # one very common vector
    rows += [(2000, None), (2001, [1.0, None, 2.0, 3.0, 4.0]), (2002, [1.0, float("nan"), 2.0, 3.0, 4.0]), (2003, [1.0, float("inf"), 2.0, 3.0, 4.0])]
    rows += [(2004, [1.0, 2.0]), (2005, []), (7, rows[3][1]), (7, rows[4][1]), (3000, [1e6, -1e6, -0.0, 5.0, -0.001])]
    compare(rows, whitening.whiten(frame(spark, rows)).collect(), 5)


def test_nothing_to_whiten(spark):
    assert whitening.whiten(frame(spark, [(1, None), (None, None)])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (None, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [])])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None)]).limit(0)).collect() == []


def test_null_identifiers_and_few_dimensions(spark):
    rows = [(None, [1.0, 2.0]), (None, [2.0, 2.0]), (3, [4.0, 2.5]), (3, [4.0, 2.5])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 8 and {r.component for r in got} == {1, 2} and {r.n for r in got} == {3}
    assert abs(sum({r.component: r.explained for r in got}.values()) - 1) < 1e-12


def test_numbers_beyond_a_long(spark):
    got = whitening.whiten(frame(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 4.0])])).collect()
    assert all(r.deviation is None or r.deviation >= 0 for r in got) and any(r.deviation is None for r in got)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(0, 12), st.integers(0, 1000), st.booleans())
def test_factorisation(d, rank, seed, graded):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(40, rank)) @ rnd.normal(size=(rank, d)) * (10.0 ** -np.arange(d) if graded else 1)
    a = x.T @ x
    factor = whitening.pivoted_cholesky(a)
    assert np.allclose(factor @ factor.T, a, atol=1e-10 * max(a.max(initial=0), 1e-30))
    values, vectors = whitening.one_sided_jacobi(factor)
    want = np.linalg.eigvalsh(a)[::-1]
    assert np.allclose(values, want[: len(values)], rtol=1e-9, atol=1e-13 * max(want[0], 1e-30))
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-9)


@pytest.mark.parametrize("r", range(2, 9))
def test_rounds_hold_every_pair_once(r):
    pairs = [(int(p), int(q)) for ps, qs in whitening._rounds(r) for p, q in zip(ps, qs)]
    assert sorted(pairs) == [(p, q) for p in range(r) for q in range(p + 1, r)]
