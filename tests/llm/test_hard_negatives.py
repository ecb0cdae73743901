import math

import numpy as np
import pytest

from ledgerflow.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, score string"


def brute(rows, every=50, positives=5, negatives=3, scale=256):
    seen = {}
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or not v or any(c is None or not math.isfinite(c) for c in v):
            continue
        seen[i] = min(seen.get(i, (v, label)), (v, label))
    x = {i: ([math.floor(scale * c) for c in v], label) for i, (v, label) in seen.items()}
    out = []
    for a, (u, label) in x.items():
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(u, v, strict=True)), i, other) for i, (v, other) in x.items() if i != a and len(v) == len(u))
        for s, p, _ in [r for r in scored if r[2] == label][:positives]:
            ps = -s
            fit = [(i, -t) for t, i, other in scored if other != label and 50 * ps <= -100 * t <= 95 * ps][:negatives]
            out += [(a, p, rank, i, ps, t) for rank, (i, t) in enumerate(fit, 1)]
    return sorted(out)


def got(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def rows(rnd, n, dim, labels, spread):
    base = rnd.normal(size=(labels, dim))
    out = []
    for i in range(n):
        label = int(rnd.integers(labels)) if rnd.random() > 0.33 else 0  # one hot label
        v = base[label] * spread + rnd.normal(size=dim)
        out.append((i, list(map(float, v / np.linalg.norm(v))), label, "x", "y"))
    return out


@pytest.mark.parametrize("dim,labels,spread", [(3, 2, 0.3), (8, 4, 1.0), (16, 1, 0.5)])
def test_equals_brute_force(spark, dim, labels, spread):
    rnd = np.random.default_rng(dim)
    data = rows(rnd, 400, dim, labels, spread)
    data += [(i + 1000, data[i][1], data[i + 1][2], "", "") for i in range(40)]  # equal vectors under other labels: ties
    data += [(3, data[3][1], data[3][2], "", ""), (50, data[50][1], data[50][2], "", "")]  # repeated rows
    data += [(None, data[0][1], 0, "", ""), (2000, None, 0, "", ""), (2050, [], 0, "", ""), (2100, [1.0, None] + [0.0] * (dim - 2), 0, "", ""),
             (2150, [float("nan")] * dim, 0, "", ""), (2200, data[0][1], None, "", ""), (2250, [1.0] * (dim + 1), 0, "", ""),
             (2300, [0.0] * dim, 0, "", ""), (2350, [0.0] * dim, 1, "", "")]
    assert got(hn.mine(spark.createDataFrame(data, SCHEMA).repartition(5))) == brute(data)


def test_small_cells_and_blocks(spark, monkeypatch):
    rnd = np.random.default_rng(4)
    data = rows(rnd, 300, 6, 3, 0.6)
    monkeypatch.setattr(hn, "BATCH", 20)
    monkeypatch.setattr(hn, "STRIPE", 40)
    assert got(hn.mine(spark.createDataFrame(data, SCHEMA), every=5)) == brute(data, every=5)


def test_walks_end_early_and_lose_nothing():
    """Directions in tight bundles and norms of all sizes: most of the list is never scored."""
    rnd = np.random.default_rng(8)
    x = np.floor(rnd.normal(size=(20_000, 8)) * 256 * rnd.pareto(1.5, size=(20_000, 1))).clip(-1e5, 1e5).astype(np.int32)
    chunks = hn.pa.Table.from_pylist([{"dim": 8, "label": 1, "n": len(x), "widest": 0.0, "ids": np.arange(len(x)).tobytes(), "vecs": x.tobytes()}], schema=hn.CHUNKS)
    stripe = hn.Stripe(chunks, 8)
    members = np.floor(x[0] + rnd.normal(size=(20, 8)) * 5).astype(np.int32)
    listed, bounds = stripe.shared_list(members.astype(float), np.arange(len(x)))
    scored = []
    scores = stripe.scores
    stripe.scores = lambda m, at: scored.append(len(at)) or scores(m, at)
    none = np.full(20, -1)
    wish, ids, s = hn.walk(stripe, listed, bounds, members, np.arange(20), none, np.full(20, hn.LOWEST), np.full(20, 1 << 60), 3)
    all_scores = members.astype(np.int64) @ x.T.astype(np.int64)
    for u in range(20):
        want = sorted((-int(t), i) for i, t in enumerate(all_scores[u]))[:3]
        assert [(-int(t), int(i)) for i, t in zip(ids[wish == u], s[wish == u], strict=True)] == want
    assert (all_scores[:, listed] <= np.sqrt((members.astype(float) ** 2).sum(axis=1))[:, None] * bounds[None, :]).all()
    assert sum(scored) < len(x) / 4


def test_windows_in_whole_numbers():
    for ps in (-7, 0, 1, 2, 39, 40, 41, 100, 12345):
        low, high = hn.window(np.array([ps]), 50, 95)
        for s in range(-10, ps + 2 if ps < 200 else 60):
            assert (50 * ps <= 100 * s <= 95 * ps) == (low[0] <= s <= high[0])


def test_empty_table(spark):
    assert hn.mine(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hn.mine(spark.createDataFrame([(50, [1.0], 1, "", "")], SCHEMA)).count() == 0
