import random

import public_tokenizers
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerflow.llm import token_counts
from ledgerflow.llm.chunks import by_text, pieces, segments

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rnd = random.Random(5)
    bits = ["the", " the", "  ", " ", "\n", "\t ", "don't", "'ll", "'S", "1234", "é", "ñandú", "漢字", "😀", "!!", "...", "<|endoftext|>",
            "<|endof", " ", " ", "\x1c", "​", "_", "²", "Ⅷ", "x" * 40, "\r\n", "é"]
    return ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(1500)] + ["a" * 5000, "ab " * 4000, "\n \n" * 500]


def test_counts_equal_the_library(spark, library):
    rows = [(i, t, i, "x") for i, t in enumerate(texts())] + [(None, None, 1, "x"), (7, None, 1, "x")]
    got = token_counts.count(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, n_bytes string"), PATH).collect()
    want = sorted(((i is None, i, t) for i, t, *_ in rows), key=repr)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append((r.n_bytes, r.n_tokens, r.over_limit))
    for _, i, t in want:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (len((t or "").encode()), n, n > 1024) in by_id[i], repr(t)
    assert len(got) == len(rows)
    assert token_counts.count(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_documents_equal_the_library(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in token_counts.count(docs, PATH).collect()} == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs", "Cn"]), max_size=30))
def test_any_text(text):
    merger, recent = token_counts.merger(PATH)
    library = Tokenizer.from_file(PATH) if not hasattr(test_any_text, "lib") else test_any_text.lib
    test_any_text.lib = library
    assert [sum(p) for p in by_text([text], recent, sum)] == [len(library.encode(text, add_special_tokens=False).ids)]
    joined = "".join((" " if spaced else "") + s for spaced, s in segments(text, 5))
    assert joined == text and " ".join(pieces(text)) == text
