import re
from fractions import Fraction

from conftest import SF_SMALL

from ledgerflow.llm import curriculum_mix as cm

SCHEMA = "doc_id long, text string, source string, size string, place int"


def targets(sizes):
    """Water-filling by rounds, in fractions."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: cm.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, open_, out = Fraction(3, 2) * sum(sizes.values()), set(names), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > 2 * sizes[s]}
        for s in full or open_:
            out[s] = Fraction(2 * sizes[s]) if full else unit * weight[s]
        if not full:
            break
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def check(rows, docs):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = {}, {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = targets(sizes)
    by_id = {}
    for i, t, s in docs:
        by_id.setdefault(i, []).append((size(t), sizes[s], float(want[s]), s))
    assert len(rows) == len(docs)
    for r in rows:
        match = [m for m in by_id[r.doc_id] if (r["size"], r.source_size, r.target) == m[:3]]
        assert match and 0 <= r.taken <= 2 * r["size"] and (r.position is None) == (r.taken == 0)
        assert r.position is None or 0 <= r.position <= 1
        if len({m[3] for m in by_id[r.doc_id]}) == 1:
            taken[match[0][3]] = taken.get(match[0][3], 0) + r.taken
    return taken, want


def test_table_meets_targets_and_reruns_agree(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs = [(r.doc_id, r.text, r.source) for r in df.collect()]
    rows = cm.curriculum(df).collect()
    taken, want = check(rows, docs)
    assert all(taken[s] == int(want[s]) for s in want)
    assert sorted(rows) == sorted(cm.curriculum(df.repartition(7)).collect(), key=tuple)


def test_hot_and_null_sources_ties_and_empty_table(spark):
    docs = [(i, "w " * (i % 9), "hot") for i in range(300)] + [(400 + i, "a b c", s) for i, s in enumerate(["b", None, "é", "Z", "b"])]
    docs += [(None, "x y", "hot"), (5, None, "b"), (5, "w " * 5, "hot"), (900, "", "empty")]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], SCHEMA)
    check(cm.curriculum(df).collect(), docs)
    ordered = [r.position for r in cm.in_training_order(cm.curriculum(df)).collect()]
    there = [p for p in ordered if p is not None]
    assert there == sorted(there)
    assert cm.curriculum(df.limit(0)).count() == 0


def test_copies_repeat_rows_in_training_order(spark):
    df = spark.createDataFrame([(i, "a b c d", "s" if i else "t", "z", i) for i in range(40)], SCHEMA)
    out = cm.copies(df, df.columns)
    rows = out.collect()
    assert out.columns == df.columns and all(r.place == r.doc_id and r["size"] == "z" for r in rows)
    assert max(sum(r.doc_id == i for r in rows) for i in range(40)) <= 2 and len(rows) > 40


def test_each_pass_has_its_own_position(spark):
    # "a" and "b" are at their cap of two passes, "c" takes a second pass in part
    sizes = {"a": 100, "b": 50, "c": 400}
    docs = [(1000 * k + i, "w x", s) for k, (s, n) in enumerate(sizes.items()) for i in range(n // 2)]
    df = spark.createDataFrame([(*d, "z", 1) for d in docs], SCHEMA)
    rows = cm.passes(df).collect()
    want = targets(sizes)
    for i, s in enumerate(sizes):
        a, b = cm.SCHEDULES[i]
        mine = [r for r in rows if r.doc_id // 1000 == i]
        assert sum(r.taken for r in mine) == int(want[s])
        begun = 0
        for r in sorted((r for r in mine if r.taken), key=lambda r: r.position):
            demand = float(want[s]) * (a * r.position + (b - a) * r.position ** 2 / 2) / ((a + b) / 2)
            assert abs(demand - begun) < 1.01  # the order realises the scheduled demand at all times
            begun += r.taken


def test_copies_place_the_repeats_in_later_passes(spark):
    docs = [(i, "w x y z", s, "z", 1) for i, s in enumerate(["s"] * 60 + ["t"] * 400)]
    out = [r.doc_id for r in cm.copies(spark.createDataFrame(docs, SCHEMA), ["doc_id", "source"]).collect()]
    small = [i for i in out if i < 60]
    assert len(small) == 120 and small[:60] == small[60:] and len(set(small[:60])) == 60


def test_every_source_is_there_and_within_a_document_of_its_target(spark):
    # of 27,900 words half are wanted: "a" 1800 (its cap), "b" 4050 of its one document of 9000, "c" 8100
    docs = [(i, "w " * (1 + i % 5), "a", "z", 1) for i in range(300)] + [(900, "w " * 9000, "b", "z", 1), (901, "", "b", "z", 1)]
    docs += [(1000 + i, "w " * 20, "c", "z", 1) for i in range(900)]
    df = spark.createDataFrame(docs, SCHEMA)
    size, got = {d[0]: len(d[1].split()) for d in docs}, dict.fromkeys("abc", 0)
    want = {r.source: r.target for r in cm.source_targets(df.selectExpr("source", "size(split(trim(text), ' ')) - int(text = '') size"), share=(1, 2)).collect()}
    assert want == {"a": 1800, "b": 4050, "c": 8100}
    for r in cm.copies(df, ["doc_id", "source"], share=(1, 2)).collect():
        got[r.source] += size[r.doc_id]
    assert got["b"] == 9000 and got["a"] == 1800 and abs(got["c"] - 8100) <= 20
