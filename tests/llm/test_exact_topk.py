import numpy as np

from ledgerflow.llm import exact_topk

SCHEMA = "vec_id long, embedding array<float>, rank int, score string"


def brute(rows, k):
    v = {i: np.floor(64 * np.array(e, dtype=np.float64)).astype(object) for i, e, *_ in rows}
    out = set()
    for q in v:
        if q % 20 == 0:
            s = sorted((-(v[q] * v[x]).sum(), x) for x in v if x != q and len(v[x]) == len(v[q]))[:k]
            out |= {(q, r + 1, x, -n) for r, (n, x) in enumerate(s)}
    return out


def got(spark, rows, **kw):
    return {tuple(r) for r in exact_topk.search(spark.createDataFrame(rows, SCHEMA), **kw).collect()}


def test_equals_brute_force_with_ties_and_large_components(spark):
    rng = np.random.default_rng(3)
    f32 = lambda m: [[float(np.float32(x)) for x in r] for r in m]
    rows = [(i, e, 1, "x") for i, e in enumerate(f32(rng.normal(size=(200, 5))))]
    rows += [(200 + i, f32([[0.5] * 5])[0], 1, "x") for i in range(60)]  # ties
    rows += [(300 + i, e, 1, "x") for i, e in enumerate(f32(rng.normal(size=(30, 3)) * 1e6))]  # scores beyond 2^53
    assert got(spark, rows, k=7, bins=4) == brute(rows, 7)
    assert got(spark, rows, k=100) == brute(rows, 100)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1, None), (0, [1.0, 0.0], 1, None), (1, [0.5, 0.5], 1, None), (2, None, 1, None),
            (20, [nan, 1.0], 1, None), (40, [None, 1.0], 1, None), (60, [inf, 1.0], 1, None), (80, [], 1, None), (None, [1.0, 1.0], 1, None)]
    assert got(spark, rows) == {(0, 1, 1, 2048)}
    assert got(spark, []) == set()


def test_numbers_of_every_width_keep_their_values():
    import numpy as np
    from ledgerflow.llm.vectors import narrowest, widened

    for most, width in ((0, 2), (32_767, 2), (32_768, 4), (2**31 - 1, 4), (2**31, 8), (2**61, 8)):
        v = np.array([[most, -most, 1], [0, 5, -1]], float)
        data = narrowest(v).tobytes()
        assert len(data) == width * v.size and (widened(data, 2, 3) == v.astype(np.int64)).all()
    assert widened(b"", 0, 3).shape == (0, 3)


def test_vectors_of_different_widths_meet(spark):
    rows = [(20 * i, [float(i), -1.0, 2.0 ** (i % 20)]) for i in range(40)]
    out = exact_topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5), k=3).collect()
    whole = {i: [int(64 * c) for c in v] for i, v in rows}
    for q in whole:
        best = sorted((-sum(a * b for a, b in zip(whole[q], whole[i], strict=True)), i) for i in whole if i != q)[:3]
        assert [(-r.score, r.vec_id) for r in sorted((r for r in out if r.query_id == q), key=lambda r: r["rank"])] == best
