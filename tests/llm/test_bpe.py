import hashlib

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from barlake.llm import bpe

PATH = public.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def model():
    return bpe.ByteBpe(bpe.read_ranks(PATH), public.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.read_ranks(PATH),
                             special_tokens={})


def ids(model, text):
    return np.frombuffer(model.encode(text), "<u4").tolist()


def test_every_token_is_its_own_encoding(model):
    assert all(model.merge(raw) == [i] for raw, i in model.ranks.items())


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=400) | st.text("ab ", max_size=300) | st.text(" \n\t'sré0é", max_size=300))
def test_text_equals_library(model, library, text):
    assert ids(model, text) == library.encode_ordinary(text)


def test_small_leaves_equal_library(model, library, monkeypatch):
    monkeypatch.setattr(bpe, "LEAF_CHARS", 7)
    monkeypatch.setattr(bpe, "LEAF_BYTES", 3)
    monkeypatch.setattr(bpe, "LEAF_IDS", 5)
    rng = np.random.default_rng(1)
    for alphabet in ("ab", "the andon ", " \n\tx'rel", "aéß日0 ", "=-=#!! "):
        for _ in range(60):
            text = "".join(rng.choice(list(alphabet), rng.integers(0, 150)))
            fresh = bpe.ByteBpe(model.ranks, public.PATTERN)
            got = ids(fresh, text)
            assert got == library.encode_ordinary(text), text
            assert fresh.decode(np.array(got, np.uint32)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 70_000, " " * 70_000, "\n" * 50_001 + "x", "ab" * 40_000,
                                  "word " * 20_000, "é" * 40_000 + " end", "'re" * 30_000])
def test_long_texts(model, library, text):
    assert ids(model, text) == library.encode_ordinary(text)


def test_documents(spark, library):
    rows = [(1, "Hello world, hello."), (None, "x"), (2, None), (3, ""), (3, ""), (4, "ö" * 40_000)]
    df = spark.createDataFrame([(a, b, "clash") for a, b in rows], "doc_id bigint, text string, ids string")
    got = bpe.encode_documents(df, PATH, public.PATTERN).collect()
    assert len(got) == len(rows)
    for row, (doc_id, text) in zip(got, rows):
        want = np.array(library.encode_ordinary(text or ""), "<u4").tobytes()
        assert row.doc_id == doc_id and row.n_tokens == len(want) // 4 and row.round_trip
        assert row.ids_sha256 == hashlib.sha256(want).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.encode_documents(df.limit(0), PATH, public.PATTERN).count() == 0
