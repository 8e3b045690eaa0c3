"""Quality classifier on learned subword embeddings (operator 2).

A document is the average of learned vectors: one for each of its words, one
for each character three- and four-gram of the words (with their ends
marked), one where a word repeats the word before it, and one for the end of
the text. Vectors live in hashed buckets. A softmax layer over the average
gives the score. Vectors and layer are trained together by stochastic
gradient descent in numpy.

Learning reads a bounded sample: the ``sample_rows`` labelled rows with the
least hash of their identifier; their bucket counts are made on the executors.
Scoring reads every whole text. The layer is linear, so each bucket is scored
once and a document's score is the softmax of its features' average.

Defined cases: null text counts as empty, and an empty text gets the score of
the end mark alone; rows without label or identifier are not learned from; of
repeated identifiers one row is; ties in the hash fall to the smaller
identifier; repeated rows get equal scores; an empty table gives an empty
result; without labels every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts

BUCKETS = 1 << 17
WIDTH = 16
SAMPLE_ROWS = 6000
CACHE_WORDS = 300_000
LONG_WORD = 64  # longer words are not cached
_MARK, _REPEAT = b"\x00end", b"\x00repeat"


def word_buckets(word: str) -> Iterator[int]:
    data = word.encode("utf-8", "surrogatepass")
    yield crc32(b"\x01" + data) % BUCKETS
    ended = f"<{word}>"
    for n in (3, 4):
        for i in range(len(ended) - n + 1):
            yield crc32(ended[i:i + n].encode("utf-8", "surrogatepass")) % BUCKETS


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ np.where(table & 1, np.uint32(0xEDB88320), np.uint32(0))
    return table


_CRC = _crc_table()


def _crcs(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of many short stretches of ``data``, a byte of each at a time."""
    crc = np.full(len(begin), 0xFFFFFFFF, np.uint32)
    for k in range(int(size.max(initial=0))):
        at = np.flatnonzero(size > k)
        now = crc[at]
        crc[at] = _CRC[(now ^ data[begin[at] + k]) & 0xFF] ^ (now >> 8)
    return ~crc


def words_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``word_buckets`` of many short words, one after the other, and how many each has."""
    data = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-8", "surrogatepass"), np.uint8)
    edge = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # where characters begin
    length = np.fromiter(map(len, words), np.int64, len(words)) + 2
    sizes = 2 * length - 4
    first, word = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(words)), length)
    place = np.arange(len(word)) - (np.cumsum(length) - length)[word]
    out = np.empty(int(sizes.sum()), np.int64)
    out[first] = [crc32(b"\x01" + w.encode("utf-8", "surrogatepass")) for w in words]
    for n, start in ((3, first + 1), (4, first + length - 1)):
        at = np.flatnonzero(place <= length[word] - n)
        out[start[word[at]] + place[at]] = _crcs(data, edge[at], edge[at + n] - edge[at])
    return out % BUCKETS, sizes


_FIXED = [crc32(_MARK) % BUCKETS, crc32(_REPEAT) % BUCKETS]


def repeats(words: list[str]) -> int:
    return sum(map(str.__eq__, words, words[1:]))


def document_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A text's buckets and how often each occurs."""
    words = (text or "").split()
    counts: dict[int, int] = {_FIXED[0]: 1}
    if n := repeats(words):
        counts[_FIXED[1]] = counts.get(_FIXED[1], 0) + n
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    for w, n in seen.items():
        for b in word_buckets(w):
            counts[b] = counts.get(b, 0) + n
    return np.fromiter(counts.keys(), np.int32, len(counts)), np.fromiter(counts.values(), np.float32, len(counts))


class Model:
    """What each bucket adds to the odds of label 1; of fixed size, so it is broadcast whole."""

    def __init__(self, weight: np.ndarray):
        self.weight = weight.astype(np.float32)
        self.words: _Words | None = None  # made by the Python worker that scores, kept over its tasks

    @classmethod
    def train(cls, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 8,
              rate: float = 10.0, seed: int = 11) -> Model:
        rng = np.random.default_rng(seed)
        vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
        layer = np.zeros((2, WIDTH), np.float32)
        total, done = max(1, epochs * len(rows)), 0
        for _ in range(epochs):
            for r in rng.permutation(len(rows)):
                bucket, count = rows[r]
                share = count / count.sum()
                hidden = share @ vectors[bucket]
                logit = layer @ hidden
                odds = np.exp(logit - logit.max())
                error = odds / odds.sum()
                error[labels[r]] -= 1
                step = np.float32(rate * (1 - done / total))
                back = error @ layer
                layer -= np.float32(0.02) * step * np.outer(error, hidden)
                vectors[bucket] -= step * np.outer(share, back)
                done += 1
        return cls(vectors @ (layer[1] - layer[0]))

    def scorer(self) -> Callable[[list], list[list]]:
        if self.words is None:
            self.words = _Words(self.weight)
        weight, cache = self.weight, self.words

        def score(texts: list) -> list[list]:
            out = []
            for text in texts:
                words = (text or "").split()
                if len(cache) > CACHE_WORDS:
                    cache.restart()
                n, total, features = repeats(words), 0.0, 0
                if len(text or "") > LONG_WORD and any(len(w) > LONG_WORD for w in words):
                    for word in words:
                        if len(word) > LONG_WORD:
                            buckets = word_buckets(word)
                            while part := list(islice(buckets, 1 << 16)):
                                total += float(weight[part].sum(dtype=np.float64))
                                features += len(part)
                    words = [w for w in words if len(w) <= LONG_WORD]
                cache.add([w for w in set(words) if w not in cache])
                at = np.fromiter(map(cache.__getitem__, words), np.int64, len(words))
                total += float(cache.sums[at].sum()) + float(weight[_FIXED[0]]) + n * float(weight[_FIXED[1]])
                features += int(cache.sizes[at].sum()) + 1 + n
                out.append(float(1 / (1 + np.exp(-np.clip(total / features, -50, 50)))))
            return [out]
        return score


class _Words(dict):
    """Row number by word; per row the sum of its buckets' weights and their number."""

    def __init__(self, weight: np.ndarray):
        super().__init__()
        self.weight = weight
        self.sums, self.sizes = np.zeros(1 << 16), np.zeros(1 << 16, np.int64)

    def restart(self) -> None:
        self.clear()

    def add(self, words: list[str]) -> None:
        """New words, all at once."""
        if not words:
            return
        first, end = len(self), len(self) + len(words)
        while end > len(self.sums):
            self.sums, self.sizes = np.resize(self.sums, 2 * len(self.sums)), np.resize(self.sizes, 2 * len(self.sizes))
        buckets, sizes = words_buckets(words)
        weights = self.weight[buckets].astype(np.float64)
        self.sums[first:end], self.sizes[first:end] = np.add.reduceat(weights, np.cumsum(sizes) - sizes), sizes
        self.update(zip(words, range(first, end)))


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from the labelled rows of ``docs``; ``labels`` has the identifier and a label of 0 or 1."""
    picked = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
              .where("id is not null and label in (0, 1)").groupBy("id").agg(F.min("label").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(sample_rows))
    rows = (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
            .join(F.broadcast(picked), "id").groupBy("id", "label").agg(F.min("text").alias("text")))

    def make() -> Callable:
        def run(texts: list) -> list[list]:
            found = [document_counts(t) for t in texts]
            return [[b.tobytes() for b, _ in found], [c.tobytes() for _, c in found]]
        return run
    found = map_texts(rows, make, "buckets binary, counts binary").orderBy(F.xxhash64("id"), "id").toArrow()
    counted = [(np.frombuffer(b, np.int32), np.frombuffer(c, np.float32))
               for b, c in zip(found.column("buckets").to_pylist(), found.column("counts").to_pylist())]
    return Model.train(counted, found.column("label").to_numpy())


def score(spark: SparkSession, docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with score (0 to 1, higher: label 1 likelier)."""
    shared = spark.sparkContext.broadcast(model)

    def make() -> Callable:
        return shared.value.scorer()
    return map_texts(docs, make, "score double", text_col)
