import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerflow.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def check(rows, texts, window=1024):
    library = Tokenizer.from_file(PATH)
    want = []
    for i, t in texts:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((i, len(ids), ids))
    total = 0
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, n, ids in want:
        same = [w for w in want if w[0] == i]
        if len(same) == 1:
            at = 0
            for r in sorted(by_doc[i], key=lambda r: r.start):
                assert (r.start, r.doc_tokens) == (at, n)
                assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
                at += r.length
            assert at == n
        total += n
    assert sum(r.length for r in rows) == total
    for rs in by_sequence.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return total / (len(by_sequence) * window) if by_sequence else 1.0


def test_whole_table_packs_tightly(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = packing.pack(docs, PATH).collect()
    assert check(rows, [(r.doc_id, r.text) for r in docs.collect()]) > 0.95


def test_nulls_copies_and_empty_table(spark):
    texts = [(None, "a b"), (1, None), (2, ""), (3, "word " * 3000), (4, "x y"), (4, "x y"), (5, "<|endoftext|> a")]
    schema = "doc_id long, text string, length string, rank int"
    rows = packing.pack(spark.createDataFrame([(*t, "l", 1) for t in texts], schema), PATH).collect()
    check(rows, texts)
    assert packing.pack(spark.createDataFrame([], schema), PATH).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from(" \n\t'\u3000\u00e9\u6f22"), st.characters(exclude_categories=["Cs", "Cn"])), max_size=24))
def test_ids_equal_the_library(text):
    ids = next(packing.token_ids(PATH, [text]))
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_texts_of_both_encoders_keep_their_order():
    texts = ["plain text", "\u6f22\u5b57 here", "", "a<|endoftext|> b", "caf\u00e9  au lait", "\u03b1\u03b2", " \n", "x" * 70 + "\u2019s end", "last"]
    got = [np.frombuffer(x, "<u4").tolist() for x in packing.token_ids(PATH, texts)]
    assert got == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_very_long_text_is_cut_into_segments():
    text = "  ".join(f"word{i} and\tmore" for i in range(150_000))
    assert len(text) > 2 * 1_500_000
    assert np.frombuffer(next(packing.token_ids(PATH, [text])), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_one_length_over_many_blocks(spark, monkeypatch):
    """Most pieces have one length and stand in many blocks of several tasks."""
    monkeypatch.setattr(packing, "HELD_BYTES", 4096)
    texts = [(i, "same words in every text " * (3 + 300 * (i % 50 == 0))) for i in range(900)]
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string").repartition(5), PATH).collect()
    assert check(rows, texts) > 0.95
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


def test_the_file_is_read_by_ranks():
    special, ids = packing.merges_in_id_order(PATH)
    assert special == ["<|endoftext|>"] and ids(" hello world") == LIBRARY.encode(" hello world", add_special_tokens=False).ids


@pytest.mark.parametrize("window", [16, 64])
def test_plan_uses_every_count_once(window):
    rng = np.random.default_rng(window)
    for size in (3, 100, 100_000):
        histogram = np.bincount(rng.integers(1, window + 1, size), minlength=window + 1)
        used = np.zeros(window + 1, int)
        windows = packing.plan(histogram, window)
        for lengths, times in windows:
            assert sum(lengths) <= window and times > 0
            for n in lengths:
                used[n] += times
        assert (used == histogram).all()
        if size > 1000:
            assert (histogram * np.arange(window + 1)).sum() / (sum(t for _, t in windows) * window) > 0.99


def test_least_squares_meets_a_histogram_that_fits():
    rows = packing.combinations(np.arange(1, 33), 32)
    assert (rows.sum(axis=1) == 32).all()
    histogram = np.bincount(rows.ravel(), minlength=33).astype(float)
    histogram[0] = 0
    x = packing.least_squares(rows, histogram)
    got = np.bincount(rows.ravel(), weights=np.repeat(x, 3), minlength=33)
    assert (x >= 0).all() and abs(got - histogram)[1:].max() < 0.05 * histogram.max()


def test_sequences_hold_the_ids_of_the_texts(spark):
    texts = [(i, f"text number {i} " * (1 + 97 * i % 400)) for i in range(60)]
    packed = packing.pack(spark.createDataFrame(texts, "doc_id long, text string"), PATH).cache()
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packing.sequences(packed).collect()}
    assert max(map(len, whole.values())) <= 1024
    got = {i: [] for i, _ in texts}
    for r in sorted(packed.collect(), key=lambda r: (r.doc_id, r.start)):
        got[r.doc_id] += whole[r.sequence_id][r.offset:r.offset + r.length].tolist()
    assert got == {i: [*LIBRARY.encode(t, add_special_tokens=False).ids, 0] for i, t in texts}


def test_query_keeps_its_columns(spark):
    from ledgerflow.llm.queries import op8_packing

    rows = op8_packing(spark, SF_SMALL)
    assert rows.dtypes == [("doc_id", "bigint"), *[(c, "bigint") for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]]
    check(rows.collect(), [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()])
