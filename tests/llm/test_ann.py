import numpy as np

from conftest import SF_SMALL
from ledgerflow.llm import ann

SCHEMA = "vec_id long, embedding array<float>, rank int, score string"


def exact(rows, k=20):
    v = {i: np.array(e, dtype=np.float64) for i, e in rows}
    ids = np.array(sorted(v))
    m = np.array([v[i] for i in ids])
    out = {}
    for q in ids[ids % 20 == 0]:
        s = ann.inner_products(np.repeat(v[q][None], len(m), 0), m)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[int(q)] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_recall_and_exact_scores(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    want = exact([(r.vec_id, r.embedding) for r in e.collect()])
    got = found(ann.search(e))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    for q, pairs in got.items():
        assert len(pairs) == 20 and pairs == sorted(pairs, key=lambda p: (-p[1], p[0]))
        true = dict(want[q])
        assert all(true[i] == s for i, s in pairs if i in true)


def test_few_candidates_ties_and_rows_that_take_no_part(spark):
    nan = float("nan")
    rows = [(0, [3.0, 4.0]), (1, [-3.0, -4.0]), (2, [0.5, 0.5]), (3, [0.5, 0.5]), (3, [0.5, 0.5]), (4, [0.0, 0.0]), (5, None),
            (20, [nan, 1.0]), (40, [None, 1.0]), (None, [1.0, 1.0]), (60, [1.0, 2.0, 3.0]), (61, [1.0, 0.0, 0.0])]
    got = found(ann.search(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)))
    assert got == {0: [(2, 3.5), (3, 3.5), (1, -25.0)], 60: [(61, 1.0)]}
    assert found(ann.search(spark.createDataFrame([], SCHEMA))) == {}


def test_probe_order_is_by_ascending_cost():
    order = ann.probe_order(np.array([0.2, 0.9]), 1.0, 6)
    walls = {(0, -1): 0.2, (0, 1): 0.8, (1, -1): 0.9, (1, 1): 0.1}
    cost = [sum(walls[s] ** 2 for s in p) for p in order]
    assert order[0] == [] and cost == sorted(cost) and len(order) == 6
