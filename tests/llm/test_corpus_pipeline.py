"""The pipeline stage by stage against what each stage must keep and change."""

import re

import corpus_pipeline as cp
import pytest
from conftest import SF_CHECK, SF_SMALL
from test_jaccard_join import brute
from test_packing import check as check_pieces

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF_SMALL).cache()
        out.append((docs.columns, docs.collect()))
    return out


def test_quality_stage_drops_junk_and_keeps_clean(spark, stages):
    before = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert all(before[r.doc_id] == r for r in stages[0][1])
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    kept = {r.doc_id for r in cp.good_documents(spark, docs, SF_CHECK).collect()}
    for quality in (0, 1):
        right = [(i in kept) == bool(quality) for i, q in labels.items() if q == quality]
        assert sum(right) / len(right) > 0.97


def test_near_copies_leave_one_of_each_group(stages):
    rows = [(r.doc_id, r.text) for r in stages[0][1]]
    want = {i for i, _, c in brute(rows) if i == c}
    assert {r.doc_id for r in stages[1][1]} == want and len(stages[1][1]) == len(want)


def test_personal_data_is_masked_and_the_rest_stays(stages):
    before = {r.doc_id: r for r in stages[1][1]}
    after = {r.doc_id: r for r in stages[2][1]}
    assert before.keys() == after.keys()
    found = 0
    for i, r in after.items():
        assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]", r.text)
        assert (r.lang, r.source, r.n_chars) == (before[i].lang, before[i].source, len(r.text))
        if "[EMAIL]" not in r.text and "[PHONE]" not in r.text and "[CARD]" not in r.text and "[IP]" not in r.text:
            assert r.text == before[i].text
        else:
            found += 1
    assert 0 < found < len(after) / 2


def test_mixing_repeats_whole_documents(stages):
    before = {r.doc_id: r for r in stages[2][1]}
    after = stages[3][1]
    assert all(before[r.doc_id] == r for r in after)
    size = lambda rs: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rs)
    assert abs(size(after) / size(before.values()) - 1.5) < 0.1


def test_packing_holds_every_mixed_document(stages):
    check_pieces(stages[4][1], [(r.doc_id, r.text) for r in stages[3][1]])


def test_columns_and_registration(stages):
    assert all(c == cp.COLUMNS for c, _ in stages[:-1])
    q = entry.queries()
    assert "pipeline" in q and all(any(k.startswith(f"op{n}_") for k in q) for n in range(1, 14))
    assert "pipeline" not in entry.oracle_sql()


def test_empty_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, score int")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0


def test_odd_rows_go_through_every_stage(spark):
    """Null, empty, repeated and very long texts, null ids, ties and a clashing column."""
    long = " ".join(f"word{i}" for i in range(60_000))
    texts = [(1, None), (2, ""), (3, long), (4, long + " and a tail"), (5, "a short note of seven words, mail x@y.org"), (5, "a short note of seven words, mail x@y.org"),
             (None, "no id stands before this text"), (None, None), (7, " \n"), (8, long.replace("word", "wort") + " card: 4111 1111 1111 1111")]
    docs = spark.createDataFrame([(i, t, "en", "s" if (i or 0) % 2 else None, None if t is None else len(t), "x") for i, t in texts],
                                 "doc_id long, text string, lang string, source string, n_chars long, label string")
    known = {repr(t) for _, t in texts}
    assert {repr(r.text) for r in cp.good_documents(spark, docs, SF_SMALL).collect()} <= known  # whatever the classifier says of them
    unique = cp.one_of_near_copies(spark, docs, SF_SMALL)
    assert sorted(((r.doc_id, r.text and r.text[:6]) for r in unique.collect()), key=repr) == sorted(
        [(1, None), (2, ""), (3, "word0 "), (5, "a shor"), (None, "no id "), (None, None), (7, " \n"), (8, "wort0 ")], key=repr)
    masked = cp.without_personal_data(spark, unique, SF_SMALL)
    rows = {(r.doc_id, r.text): r.n_chars for r in masked.collect()}
    assert len(rows) == 8 and all(n == (None if t is None else len(t)) for (_, t), n in rows.items())
    whole = {i: t for i, t in rows if i is not None}
    assert "x@y.org" not in whole[5] and whole[8].startswith("wort0 wort1 ") and "4111 1111" not in whole[8] and whole[3] == long
    mixed = cp.mixed(spark, masked, SF_SMALL).cache()
    assert mixed.columns == cp.COLUMNS and {(r.doc_id, r.text) for r in mixed.collect()} <= set(rows)
    assert {(1, None), (2, ""), (7, " \n"), (None, None)} <= {(r.doc_id, r.text) for r in mixed.collect()}
    check_pieces(cp.packed(spark, mixed, SF_SMALL).collect(), [(r.doc_id, r.text) for r in mixed.collect()])
