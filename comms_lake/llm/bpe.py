"""Byte-level BPE encoding and decoding (operator 5).

Text is split by the vocabulary's pattern; no merge crosses a match. The merge
loop, over all new matches of some texts at once, holds candidate pairs in one
bucket per merge rank. A
hierarchical bitmap over the ranks (256 bits a word, two levels) finds the next
rank by find-first-set; a bucket holds linked-list positions, taken smallest
first, so equal ranks merge from the left. An entry whose pair has changed
since is stale and skipped. The work is n log n for a match of n bytes, so
matches of millions of bytes are no special case.

Defined cases: null text counts as empty; empty text has no ids and decodes
to empty bytes; repeated rows are encoded each; an empty table gives an empty
result; ids that are not in the vocabulary are an error when decoding.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import chain

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts

MULTI_50K = "byte_bpe_multi_50k.tiktoken"
# Encoded matches kept between the texts of a task: so many of so many characters at most.
CACHE_ENTRIES, CACHE_CHARS = 500_000, 40
TOGETHER = 2000  # matches merged at once: their lists stay in the processor's cache
STOP = 1 << 19  # no rank is as great


def narrow_pattern(pattern: str) -> Callable[[str], list[str]] | None:
    """``pattern`` for texts of U+0000 to U+00FF, with its Unicode classes spelled out for
    Python's own, faster matcher; None if it uses others than letters, numbers and white space."""
    of = lambda test: "".join(re.escape(chr(c)) for c in range(256) if test(chr(c)))
    letters = of(lambda c: unicodedata.category(c)[0] == "L")
    numbers = of(lambda c: unicodedata.category(c)[0] == "N")
    space = of(lambda c: c in "\t\n\x0b\x0c\r \x85\xa0")
    out = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letters}{numbers}]")
    for name, chars in ((r"\p{L}", f"[{letters}]"), (r"\p{N}", f"[{numbers}]"), (r"\S", f"[^{space}]"), (r"\s", f"[{space}]")):
        out = out.replace(name, chars)
    return None if re.search(r"\\[pPsSwWdDbB]", out) or "(?i" in out else re.compile(out).findall


class Codec:
    """Encoder and decoder for one rank file and one split pattern."""

    def __init__(self, lines: list[bytes], pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        if max(self.ranks.values(), default=0) >= STOP:
            raise ValueError(f"ranks must be below {STOP}")
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.any, self.narrow = regex.compile(pattern).findall, narrow_pattern(pattern)
        self.cache: dict[str, tuple[int, ...]] = {}
        # Rank of the token that two tokens make, by both their ranks.
        get = self.ranks.get
        self.pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                if (left := get(token[:cut])) is not None and (right := get(token[cut:])) is not None:
                    self.pairs[left << 20 | right] = rank
        self.bytes = [get(bytes([x])) for x in range(256)]
        self.low = [0] * ((max(self.ranks.values(), default=0) >> 8) + 1)
        self.bit = [1 << k for k in range(max(256, len(self.low)))]

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each match. All of them stand in one linked list, a stop
        between neighbours that no pair crosses, and share one queue: ``top``
        has a bit for each word of ``low`` that is not zero, ``low`` a bit for
        each rank with a bucket; all of ``low`` is zero again at the end."""
        get, low, bit, single = self.pairs.get, self.low, self.bit, self.bytes
        token: list[int | None] = []  # by position; None where merged into the one before
        starts = []
        for piece in pieces:
            starts.append(len(token))
            token += [single[x] for x in piece]
            token.append(STOP)
        n = len(token)
        after = list(range(1, n + 1))  # where the token at a position ends and the next begins
        before = list(range(-1, n))
        pair = [get(x << 20 | y) for x, y in zip(token, token[1:])]  # rank of the pair that begins at a position
        pair.append(None)
        buckets: dict[int, list[int]] = {}
        for i, rank in enumerate(pair):
            if rank is not None:
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
        top = 0
        for rank in buckets:
            low[rank >> 8] |= bit[rank & 255]
            top |= bit[rank >> 8]
        while top:
            word = (top & -top).bit_length() - 1
            bits = low[word]
            rank = (word << 8) + (bits & -bits).bit_length() - 1
            low[word] = bits = bits & (bits - 1)
            if not bits:
                top &= top - 1
            bucket = buckets.pop(rank)
            if len(bucket) > 1:
                bucket.sort()
            waiting: set[int] = set()  # matches in which a lower rank has come up: their rest of the bucket waits
            later = []
            for i in bucket:
                if pair[i] != rank:
                    continue  # stale: this pair has grown or gone
                if waiting and bisect_right(starts, i) in waiting:
                    later.append(i)
                    continue
                gone = after[i]
                end = after[i] = after[gone]
                token[i], token[gone], pair[gone] = rank, None, None
                before[end] = i
                pair[i] = new = get(rank << 20 | token[end])
                if new is not None:
                    if new in buckets:
                        buckets[new].append(i)
                    else:
                        buckets[new] = [i]
                        place = new >> 8
                        low[place] |= bit[new & 255]
                        top |= bit[place]
                    if new < rank:
                        waiting.add(bisect_right(starts, i))
                left = before[i]
                if left >= 0:
                    pair[left] = new = get(token[left] << 20 | rank)
                    if new is not None:
                        if new in buckets:
                            buckets[new].append(left)
                        else:
                            buckets[new] = [left]
                            place = new >> 8
                            low[place] |= bit[new & 255]
                            top |= bit[place]
                        if new < rank:
                            waiting.add(bisect_right(starts, i))
            if later:
                buckets[rank] = later
                low[word] |= bit[rank & 255]
                top |= bit[word]
        out, ids = [], []
        for x in token:
            if x == STOP:
                out.append(ids)
                ids = []
            elif x is not None:
                ids.append(x)
        return out

    def split(self, text: str) -> list[str]:
        """The pattern's matches."""
        if self.narrow is not None:
            try:
                text.encode("latin-1")
                return self.narrow(text)
            except UnicodeEncodeError:
                pass
        return self.any(text)

    def encode_all(self, texts: list) -> Iterator[list[int]]:
        """Token ids of each text, in order; matches that no text had before are merged together."""
        cache, split = self.cache, [self.split(t or "") for t in texts]
        new = list(set().union(*split).difference(cache))
        data = [m.encode() for m in new]
        whole = self.ranks.get
        rest = [k for k, d in enumerate(data) if whole(d) is None]
        cache.update((m, (whole(d),)) for m, d in zip(new, data) if whole(d) is not None)
        for at in range(0, len(rest), TOGETHER):
            part = rest[at:at + TOGETHER]
            cache.update((new[k], tuple(ids)) for k, ids in zip(part, self.merge([data[k] for k in part])))
        for matches in split:
            yield list(chain.from_iterable(map(cache.__getitem__, matches)))
        for m in new:
            if len(m) > CACHE_CHARS:
                del cache[m]
        if len(cache) > CACHE_ENTRIES:
            cache.clear()

    def encode(self, text: str | None) -> list[int]:
        return list(self.encode_all([text]))[0]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_CODECS: dict[tuple[str, str], Codec] = {}


class Tokenizer:
    """A rank file read on the driver and broadcast (a vocabulary has a fixed
    size, about 1 MB); executors build the codec once per Python worker."""

    def __init__(self, spark: SparkSession, path: str | None = None, pattern: str = public_tokenizers.PATTERN):
        with open(path or public_tokenizers.path(MULTI_50K), "rb") as f:
            data = f.read()
        self.digest, self.pattern = hashlib.sha256(data).hexdigest(), pattern
        self.ranks = spark.sparkContext.broadcast(data.splitlines())

    def codec(self) -> Codec:
        key = (self.digest, self.pattern)
        if key not in _CODECS:
            _CODECS.clear()
            _CODECS[key] = Codec(self.ranks.value, self.pattern)
        return _CODECS[key]



def encode_documents(docs: DataFrame, tokenizer: Tokenizer, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each whole text as array<int>."""
    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series(list(tokenizer.codec().encode_all(texts.tolist())), dtype=object)
    return docs.withColumn(out, encode(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))))


def decode_documents(docs: DataFrame, tokenizer: Tokenizer, ids_col: str = "ids", out: str = "bytes") -> DataFrame:
    """``docs`` with the bytes that each id list stands for."""
    @F.pandas_udf("binary")
    def decode(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: b"" if x is None else tokenizer.codec().decode(x))
    return docs.withColumn(out, decode(F.col(f"`{ids_col}`")))


def digests(docs: DataFrame, tokenizer: Tokenizer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256. One pass encodes and
    decodes a text at a time, so only digests travel back to the JVM."""
    def make():
        codec = tokenizer.codec()
        gc.disable()  # nothing below makes cycles; the collector would walk the cache again and again

        def digest(texts: list) -> list[list]:
            rows = []
            for ids in codec.encode_all(texts):
                rows.append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                             hashlib.sha256(codec.decode(ids)).hexdigest()))
            return [list(c) for c in zip(*rows)]
        def close() -> None:
            codec.cache.clear()
            gc.enable()
        digest.close = close
        return digest
    return map_texts(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")),
                     make, "n_tokens long, ids_sha256 string, decoded_sha256 string")
