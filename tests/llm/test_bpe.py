import random
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stormledger.llm import bpe


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(bpe.vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


CODEC = bpe.Codec(bpe.vocabulary_path())


def same(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    [got] = CODEC.encode([text])
    assert np.frombuffer(got, "<u4").tolist() == ids
    assert CODEC.decode(got).decode() == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    ["", "a<|endoftext|>b <|startoftext|>", "ΑΣ ΣΑΣ", "é́ İ ŉ ﬁ", "\x1c\x1da\x85b​c　d", "it's IT'S 12345 ½ ①",
     "日本語 👍🏽", "\x00 tab\t", "a" * 3000, "ẞ ß ǅ", ":\U0003d000a \ua7cb \u088f", "<|endoftext|", "aaaa aaab abab"],
)
def test_like_the_library(library, text):
    same(library, text)


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=60))
def test_any_text_like_the_library(library, text):
    same(library, text)


def test_frames(spark, library, documents, docs_of):
    for r in bpe.decode(bpe.encode(documents.limit(40))).collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.ids) == ids and r.decoded == library.decode(ids, skip_special_tokens=False)
    odd = docs_of([(1, None), (2, ""), (2, ""), (None, "x")]).withColumnRenamed("source", "ids_sha256")
    got = bpe.round_trip(odd).collect()
    assert sorted(r.n_tokens for r in got) == [0, 0, 0, 1] and got[0].lang is None
    assert bpe.round_trip(docs_of([])).count() == 0


def test_memory_stays_bounded_on_distinct_long_words(library, monkeypatch):
    """However many distinct words a task meets, it keeps a fixed amount of them, and ids stay right."""
    monkeypatch.setattr(bpe, "CACHE_BYTES", 2 << 20)
    monkeypatch.setattr(bpe, "LEARN_BYTES", 1 << 14)
    rng = random.Random(2)
    codec = bpe.Codec(bpe.vocabulary_path())
    slice_ = lambda: [" ".join("".join(rng.choices("abcdefghij", k=rng.randint(3, 90))) for _ in range(400)) + " same words" for _ in range(8)]
    for texts in [slice_() for _ in range(2)]:
        for text, ids in zip(texts, codec.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    tracemalloc.start()
    try:
        for _ in range(25):  # some 4 MB of words that occur once
            codec.encode(slice_())
            assert codec.cached <= (2 << 20) + (2 << 20)
        kept, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert kept < 10 << 20 and peak < 20 << 20
    texts = slice_()
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
