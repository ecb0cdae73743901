import itertools
import random
import re

import numpy as np
from conftest import SF_SMALL

from ledgerflow.llm import minhash_forest as mf
from ledgerflow.llm.shingles import shingle_sets

SCHEMA = "doc_id long, text string, class string, paths string, label int"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset({tuple(w)} if 0 < len(w) < 3 else {tuple(w[i:i + 3]) for i in range(len(w) - 2)})


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(((r[0], len(sets[i]), least[find(i)], r[0] == least[find(i)]) for i, r in enumerate(rows)), key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=repr)


def frame(spark, texts):
    return [(i, t, "x", "y", 1) for i, t in enumerate(texts)]


def edited(rnd, n):
    words = [f"w{i}" for i in range(500)] + ["Ä", "É", "Word"]
    base = [[rnd.choice(words) for _ in range(rnd.choice([1, 2, 3, 7, 20, 25, 40, 60, 200]))] for _ in range(25)]
    out = []
    for _ in range(n):
        t = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 6])):
            i = rnd.randrange(len(t) + 1)
            t[i:i + rnd.choice([0, 1])] = [rnd.choice(words)] if rnd.random() < 0.6 else []
        out.append(rnd.choice([" ", "\t", "\n "]).join(w.upper() if rnd.random() < 0.05 else w for w in t))
    return out


def test_equals_brute_force_with_every_crowd(spark):
    rnd = random.Random(11)
    rows = frame(spark, edited(rnd, 240))
    rows += [(1000 + i, t, "x", "y", 1) for i, t in enumerate([None, "", " \n", "a", "a", "A", "b c", "b C "])]
    rows += [(None, "a", "x", "y", 1), (None, "q r s", "x", "y", 1), (3, rows[3][1], "x", "y", 1), (None, None, "x", "y", 1)]
    rnd.shuffle(rows)
    want = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for crowd in (mf.CROWD, 1):  # 1: every region of several labels goes down to the exact join
        assert got(mf.near_duplicates(df, crowd)) == want


def test_crowded_regions_are_joined_exactly(spark):
    """A group of texts with a common body and one word of their own, some of them linked."""
    rnd = random.Random(5)
    short = [f"sorry the page you asked for w code x{i}" for i in range(150)]
    body = [f"b{i}" for i in range(40)]
    long = [" ".join(body[:20] + [f"own{i} tail{i % 9} c{i % 2}"] + body[20:]) for i in range(80)]
    longer = [" ".join([f"b{i}" for i in range(90)] + [f"z{k}"]) for k in range(60)]  # all linked
    texts = short + long + longer
    rnd.shuffle(texts)
    rows = frame(spark, texts)
    assert got(mf.near_duplicates(spark.createDataFrame(rows, SCHEMA), crowd=4)) == brute(rows)


def test_documents_and_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert got(mf.near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert mf.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_signatures_agree_as_the_sets_do():
    rnd = np.random.default_rng(3)
    x = rnd.integers(0, 1 << 62, 4000, dtype=np.int64).astype(np.uint64)
    paths = mf.signatures([np.sort(x[:3000]), np.sort(x[:2700]), np.sort(x[3000:]), np.sort(x[:3000])])
    values = np.stack([(paths >> (mf.BITS * d)) & ((1 << mf.BITS) - 1) for d in range(mf.DEPTH)])
    share = lambda i, j: (values[:, i] == values[:, j]).mean()
    assert share(0, 3) == 1 and abs(share(0, 1) - 0.9) < 0.12 and share(0, 2) < 0.05
    assert ((paths >> (mf.BITS * mf.DEPTH)) == np.arange(mf.TREES)).all()


def test_long_text_is_read_whole(spark):
    a = " ".join(f"w{i}" for i in range(60_000))
    b = a + " " + " ".join(f"v{i}" for i in range(9_000))  # 87 of 100
    c = a + " " + " ".join(f"u{i}" for i in range(12_000))  # 83 of 100
    rows = frame(spark, [a, b, c])
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in mf.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {0: (59_998, 0), 1: (68_998, 0), 2: (71_998, 2)}
    assert len(next(shingle_sets([a.encode()], 3))) == 59_998
