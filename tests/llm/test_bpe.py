import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from comms_lake.llm import bpe

LINES = open(public_tokenizers.path(bpe.MULTI_50K), "rb").read().splitlines()
CODEC = bpe.Codec(LINES, public_tokenizers.PATTERN)
WANT = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text_matches_and_round_trips(text):
    ids = CODEC.encode(text)
    assert ids == WANT.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


@pytest.mark.parametrize("alphabet", ["ab", "aé", " \t\na", "019", "x!?", "the ", "中文 字"])
@pytest.mark.parametrize("size", [1, 7, 2000])
def test_long_matches(alphabet, size):
    text = "".join(random.Random(size).choices(alphabet, k=size))
    assert CODEC.encode(text) == WANT.encode_ordinary(text)


def test_very_long_match_and_cache_limit(monkeypatch):
    text = "ab" * 150_000
    ids = CODEC.encode(text)
    assert CODEC.decode(ids) == text.encode() and not any(CODEC.low)
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    codec = bpe.Codec(LINES, public_tokenizers.PATTERN)
    texts = ["some words that are more than the cache holds, words and words", None, "", "x" * 50 + " some"] * 2
    assert list(codec.encode_all(texts)) == [WANT.encode_ordinary(t or "") for t in texts] and len(codec.cache) <= 3
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 1000)
    codec.encode("x" * 41 + " short")
    assert " short" in codec.cache and "x" * 41 not in codec.cache


def test_lower_rank_comes_up_inside_a_bucket():
    """A merge can make a pair of a lower rank than the one in hand; it must go first."""
    tokens = [b"a", b"b", b"c", b"abab", b"ab", b"bc", b"abc"]
    codec = bpe.Codec([base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)], r"\w+")
    own = tiktoken.Encoding("t", pat_str=r"\w+", mergeable_ranks=codec.ranks, special_tokens={})
    texts = ["".join(random.Random(k).choices("abc", k=k % 23 + 1)) for k in range(300)] + ["abababab", "abcabab", "cabababc"]
    assert list(codec.encode_all(texts)) == [own.encode_ordinary(t) for t in texts]


def test_query_and_operators(spark, docs_of):
    rows = [(1, "Hello  world"), (2, None), (3, ""), (4, "é" * 70_000), (None, "x"), (1, "Hello  world")]
    docs = docs_of(rows)
    out = bpe.digests(docs, bpe.Tokenizer(spark)).collect()
    want = sorted((str(d), len(i := WANT.encode_ordinary(t or "")),
                   hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out) == want
    both = bpe.decode_documents(bpe.encode_documents(docs.withColumn("bytes_", F.lit(1)), bpe.Tokenizer(spark)), bpe.Tokenizer(spark))
    assert all(bytes(r.bytes) == (r.text or "").encode() for r in both.collect())
    assert bpe.digests(docs.where("doc_id > 99"), bpe.Tokenizer(spark)).isEmpty()
