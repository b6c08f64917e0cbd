"""BPE against the tiktoken library, and exact round trips."""

import base64

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from fixtures import LONG, documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from sharefold.llm.bpe import ByteBpe, decode_column, encode_column, share_tokenizer

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def own():
    return ByteBpe.load(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def other():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(own, texts):
    ids, counts = own.encode(texts)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(max_size=60), min_size=1, max_size=5))
def test_any_text(own, other, texts):
    found = encoded(own, texts)
    assert found == [other.encode_ordinary(t) for t in texts]
    assert [own.decode(np.array(i, int)).decode() for i in found] == texts


def test_long_pieces(own, other):
    texts = ["a" * 3000, "ab" * 1500, " " * 2000, "", "é" * 999, "<|endoftext|>", LONG]
    assert encoded(own, texts) == [other.encode_ordinary(t) for t in texts]


def test_cache_is_bounded_and_changes_nothing(own, other, monkeypatch):
    monkeypatch.setattr("sharefold.llm.bpe.CACHED_PIECES", 10)
    monkeypatch.setattr("sharefold.llm.bpe.BLOCK_CHARS", 50)
    texts = ["".join(chr(97 + (i * j) % 26) for j in range(30)) + f" {i}" for i in range(40)]
    assert encoded(own, texts) == [other.encode_ordinary(t) for t in texts]
    assert len(own.numbers) <= 60


def test_columns(spark, own):
    shared = share_tokenizer(spark, PATH, public_tokenizers.PATTERN)
    docs = documents(spark)
    rows = docs.withColumn("ids", encode_column(shared)).withColumn("back", decode_column(shared)).collect()
    assert len(rows) == docs.count()
    assert all(bytes(r.back).decode() == (r.text or "") for r in rows)
    assert empty(spark).withColumn("ids", encode_column(shared)).count() == 0
