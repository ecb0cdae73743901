import itertools
import random
import re

from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerflow.llm import jaccard_join as jj
from ledgerflow.llm.components import components
from ledgerflow.llm.shingles import shingle_sets

SCHEMA = "doc_id long, text string, n long, component string"


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)})


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(((r[0], len(sets[i]), least[find(i)]) for i, r in enumerate(rows)), key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def texts(rnd, n=260):
    words = [f"w{i}" for i in range(400)] + ["Ä", "É", "x y", "Word"]
    shared = [[rnd.choice(words) for _ in range(60)] for _ in range(3)]
    base = [[rnd.choice(words) for _ in range(rnd.choice([1, 3, 4, 5, 7, 9, 12, 20, 40, 90, 200]))] for _ in range(40)]
    out = []
    for _ in range(n):
        t = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 5])):
            i = rnd.randrange(len(t) + 1)
            t[i:i + rnd.choice([0, 1])] = [rnd.choice(words)] if rnd.random() < 0.6 else []
        if rnd.random() < 0.2:
            t += rnd.choice(shared)
        out.append(rnd.choice([" ", "\t", "\n ", "  "]).join(w.upper() if rnd.random() < 0.05 else w for w in t))
    return out


def test_equals_brute_force(spark):
    rnd = random.Random(4)
    rows = [(i, t, 1, "x") for i, t in enumerate(texts(rnd))]
    rows += [(1000 + i, t, 1, "x") for i, t in enumerate([None, "", " \n", "a", "a", "A", "b c", "b C "])]
    rows += [(None, "a", 1, "x"), (None, "q r s", 1, "x"), (3, rows[3][1], 1, "x")]
    rnd.shuffle(rows)
    assert got(jj.join(spark.createDataFrame(rows, SCHEMA).repartition(4))) == brute(rows)


def test_any_boundary_gives_the_same_pairs(spark):
    rnd = random.Random(9)
    rows = [(i, t, 1, "x") for i, t in enumerate(texts(rnd, 150))]
    df = spark.createDataFrame(rows, SCHEMA)
    members = jj.sets(df)
    indexed = jj.index(df, members)
    by_class = {r["class"]: shingles(rows[r.doc_id][1]) for r in members.where("class is not null").collect()}
    want = {tuple(sorted((a, b))) for a, b in itertools.combinations(by_class, 2)
            if 100 * len(by_class[a] & by_class[b]) >= 75 * len(by_class[a] | by_class[b])}
    for at in (1, 12, 30, 1 << 30):
        pairs = jj.linked_pairs(jj.entries(indexed, at), indexed).collect()
        assert {(r.a, r.b) for r in pairs} == want
        assert all(r.overlap == len(by_class[r.a] & by_class[r.b]) for r in pairs)


def test_documents_and_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    assert got(jj.join(docs)) == want
    kept = jj.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _, c in want if i == c)
    assert jj.join(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_row_of_each_group_stays(spark):
    long, other = " ".join(f"w{i}" for i in range(50)), "quite another text of seven words"
    rows = [(5, long, 1, "x"), (2, long + " end", 1, "x"), (2, other, 1, "y"), (None, long, 1, "z"), (None, "alone here", 1, "z"),
            (9, None, 1, "n"), (9, None, 1, "n"), (2, other, 1, "y")]
    out = jj.one_of_each(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [(2, long + " end", 1, "x"), (2, other, 1, "y"), (None, "alone here", 1, "z"), (9, None, 1, "n"), (9, None, 1, "n")], key=repr)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (300, 200), (200, 250)]
    out = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)} | {200: 200, 250: 200, 300: 200}


def test_long_texts_are_hashed_whole(monkeypatch):
    from ledgerflow.llm import shingles as s
    text = (" ".join(f"w{i % 977}" for i in range(5000)) + "é" * 50).encode()
    whole = next(shingle_sets([text]))
    monkeypatch.setattr(s, "BUFFER", 64)
    assert (next(shingle_sets([text])) == whole).all() and len(whole) == len(shingles(text.decode()))


def test_pages_of_one_pattern_do_not_meet(spark):
    """Texts that share a list but have one shingle too many of their own: no pairs, however many there are."""
    rows = [(i, f"sorry the page you asked for w code x{i}", 1, "x") for i in range(600)] + [(1000 + i, "sorry the page you asked for w code", 1, "x") for i in range(2)]
    df = spark.createDataFrame(rows, SCHEMA)
    indexed = jj.index(df, jj.sets(df))
    listed = jj.entries(indexed).withColumn("label", F.col("class"))
    assert jj._in_reach(listed, "x.label <> y.label").count() < 10 * 602  # each may meet the shorter text only
    assert got(jj.join(df)) == brute(rows)


def test_entries_in_reach_are_all_that_may_link(spark):
    rnd = random.Random(6)
    data = [(k, i, n, rnd.randint(1, n), 0, True, i % 7) for k in range(3) for i, n in enumerate(rnd.choices(range(1, 60), k=80))]
    listed = spark.createDataFrame(data, "key long, class long, n int, left int, alone int, scans boolean, label long")
    pairs = {tuple(sorted(((r[0], r[1]), (r[0], r[2])))) for r in jj._in_reach(listed, "x.label <> y.label").selectExpr("x.key", "x.class", "y.class").collect()}
    want = {tuple(sorted(((a[0], a[1]), (b[0], b[1])))) for a, b in itertools.combinations(data, 2)
            if a[0] == b[0] and a[6] != b[6] and 4 * a[2] >= 3 * b[2] and 4 * b[2] >= 3 * a[2] and 7 * min(a[3], b[3]) >= 3 * (a[2] + b[2])}
    assert pairs == want and len(want) > 20
