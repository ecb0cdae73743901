from fractions import Fraction

import numpy as np
import pytest
from conftest import SF_SMALL

from ledgerflow.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<double>, component string, n string"


def whole(vectors):
    return [[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors]


def brute(vectors):
    """(sums, covariance by exact fractions) of whole-number vectors."""
    x = whole(vectors)
    n, dim = len(x), len(x[0])
    sums = [sum(v[i] for v in x) for i in range(dim)]
    mean = [Fraction(s, n) for s in sums]
    v = [[float(sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n) for j in range(dim)] for i in range(dim)]
    return x, sums, np.array(v)


def test_jacobi_gives_eigenvalues_and_vectors():
    rnd = np.random.default_rng(1)
    for d, rank in ((1, 1), (2, 2), (7, 7), (12, 5), (40, 40)):
        m = rnd.normal(size=(d, rank)) * np.logspace(0, -3, rank)
        a = m @ m.T
        factor = wh.pivoted_cholesky(a)
        assert factor.shape == (d, rank) and np.allclose(factor @ factor.T, a, rtol=0, atol=1e-14 * np.trace(a))
        e, u = wh.jacobi(factor)
        assert np.allclose(u.T @ u, np.eye(rank), atol=1e-9)
        assert np.allclose(e, np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-8, atol=1e-15)
        assert np.abs(a @ u - u * e).max() < 1e-13 * e[0]
    e, u = wh.jacobi(wh.pivoted_cholesky(np.array([[2.0, 0], [0, 2.0]])))  # equal eigenvalues
    assert np.allclose(e, 2) and np.allclose(u.T @ u, np.eye(2))
    assert wh.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)


@pytest.mark.parametrize("components", [2, 32])
def test_equals_brute_force(spark, components):
    rnd = np.random.default_rng(2)
    good = [list(map(float, v)) for v in rnd.normal(size=(60, 5)) @ rnd.normal(size=(5, 5))]
    good[7] = good[6]
    rows = [(i, v, "x", "y") for i, v in enumerate(good)]
    rows[3] = (4, good[3], "x", "y")  # a repeated id
    rows[5] = (None, good[5], "x", "y")
    bad = [(90, None, "", ""), (91, [], "", ""), (92, [1.0, None, 1.0, 1.0, 1.0], "", ""), (93, [float("nan")] * 5, "", ""),
           (94, [float("inf"), 0.0, 0.0, 0.0, 0.0], "", ""), (95, [1.0, 2.0], "", "")]
    out = wh.whiten(spark.createDataFrame(rows + bad, SCHEMA).repartition(3), components).collect()
    x, sums, v = brute(good)
    n, k = len(good), min(components, 5)
    assert len(out) == n * k and {r.n for r in out} == {n} and {r.component for r in out} == set(range(1, k + 1))
    assert len({r.identity_error for r in out}) == 1 and out[0].identity_error < 1e-9
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    want = (np.array(x, float) - np.array(sums) / n) @ u / np.sqrt(e)
    deviation = {tuple(r): sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x}
    by_row = {}
    for r in out:
        by_row.setdefault((r.vec_id, int(r.deviation)), {}).setdefault(r.component, []).append(r.whitened)
        assert abs(r.explained / (e[r.component - 1] / np.trace(v)) - 1) < 1e-9
    signs = [None] * k
    for (vec_id, *_), r, w in zip(rows, x, want, strict=True):
        found = by_row[vec_id, deviation[tuple(r)]]
        for c in range(k):
            for value in found[c + 1]:
                signs[c] = signs[c] or np.sign(value / w[c])
                assert abs(value - signs[c] * w[c]) < 1e-8


def test_table(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    out = wh.whiten(e)
    rows = out.collect()
    n = e.count()
    assert len(rows) == n * 32 and rows[0].identity_error < 1e-10
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "int", "bigint", "decimal(38,0)", "double", "double", "double"]
    w = np.array([r.whitened for r in sorted(rows, key=lambda r: (r.vec_id, r.component))]).reshape(n, 32)
    assert np.abs(w.T @ w / n - np.eye(32)).max() < 1e-10


def test_degenerate_tables(spark):
    assert wh.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert wh.whiten(spark.createDataFrame([(1, None, "", "")], SCHEMA)).count() == 0
    assert wh.whiten(spark.createDataFrame([(i, [1.0, 2.0], "", "") for i in range(5)], SCHEMA)).count() == 0  # all equal
    one = wh.whiten(spark.createDataFrame([(i, [float(i), 2.0, -float(i)], "", "") for i in range(4)], SCHEMA)).collect()
    assert len(one) == 4 and abs(one[0].explained - 1) < 1e-12  # a single independent dimension


def test_large_numbers_stay_exact(spark):
    vectors = [[2.0**24 + i, -(2.0**24) + 3 * i] for i in range(40)]
    out = wh.whiten(spark.createDataFrame([(i, v, "", "") for i, v in enumerate(vectors)], SCHEMA)).collect()
    x, sums, _ = brute(vectors)
    want = {i: sum((40 * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for i, r in enumerate(x)}
    assert {r.vec_id: int(r.deviation) for r in out} == want
    with pytest.raises(Exception, match="too large"):
        wh.whiten(spark.createDataFrame([(1, [1e12], "", ""), (2, [1.0], "", "")], SCHEMA)).collect()
