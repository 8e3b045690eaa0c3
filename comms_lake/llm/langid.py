"""Language identification by nearest centroid (operator 7).

A text is a vector of hashed n-grams (one to four bytes of the lower-cased
text in UTF-8, any run of other than letters being one space): counts damped
by 1 + log, weighted by inverse document frequency, of length one. Each
language has several centroids, found by spherical k-means over its sample. A
text gets the language of the centroid with the greatest cosine. It is
rejected where that cosine is under a floor: ``REJECT_SHARE`` of a low quantile
of those that sampled texts with as many distinct n-grams have with their own
language, over that language or over all, whichever is lower. Distinct n-grams count, not length: texts of few are further from any
centroid, a line repeated a thousand times as far as one line. Pieces of the
sampled texts of many lengths set the floor for short ones.

Learning reads a bounded sample: ``sample_rows`` distinct texts of each
language (all, where it has fewer), taken by a hash of the text. Every label is
learned. Vectors (``DIMENSIONS`` floats a document), document frequencies and
centroids are made on the executors, one language in a group; the driver holds
the centroids alone (128 KB a language). Whole texts are used in learning and
prediction alike.

Defined cases: a null text or one without letters is ``und`` with score 0 and
rejected; texts of no sampled n-gram get score 0, the first language in
alphabetical order, and are rejected; ties go to the first language; repeated
rows get equal results; an empty table gives an empty result; without any
learnable row every result is ``und``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import bounded, run_dir
from .common import drop_rows, located, map_texts, stored

DIMENSIONS = 8192
SAMPLE_ROWS = 300
CENTROIDS = 4
SEED = 7
# A text is rejected under this share of this quantile of the cosines of sampled texts with as many distinct n-grams (to
# a power of two), its language's or all; where those are fewer than so many, of the next smaller size.
REJECT_SHARE, REJECT_QUANTILE, REJECT_LEAST = 0.6, 0.01, 20
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of a whole text. Long texts are counted in pieces
    that overlap by three bytes, so memory stays bounded."""
    data = np.frombuffer((" " + _OTHER.sub(" ", text.lower()) + " ").encode("utf-8", "surrogatepass"), np.uint8)
    total = np.zeros(DIMENSIONS, np.int64)
    step = 1 << 20
    for at in range(0, len(data), step):
        piece = data[at:at + step + 3].astype(np.uint32)
        own = min(step, len(data) - at)
        code = np.zeros(len(piece), np.uint32)
        for n in range(1, 5):
            code = code[:len(piece) - n + 1] * np.uint32(257) + piece[n - 1:]
            mixed = (code + np.uint32(n)) * np.uint32(2654435761)
            total += np.bincount(mixed[:own] >> np.uint32(19), minlength=DIMENSIONS)
            if n < len(piece):
                code = code[:len(piece) - n]
    return total


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=-1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def vectors(counted: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.empty(counted.shape, np.float32)
    for at in range(0, len(counted), 256):  # some at a time: the sample's temporaries stay small
        part = np.maximum(counted[at:at + 256], 1).astype(np.float32)
        out[at:at + 256] = unit((1 + np.log(part)) * (counted[at:at + 256] > 0) * idf)
    return out


def size(counted: np.ndarray) -> int:
    return int((counted > 0).sum()).bit_length()


class Model:
    """Weights and centroids; four vectors a language at most, so it is broadcast whole. ``learned``:
    each language's name, centroids, and the sizes and cosines of its sampled texts."""

    def __init__(self, idf: np.ndarray, learned: list[tuple[str, np.ndarray, np.ndarray, np.ndarray]]):
        learned = sorted(learned, key=lambda x: x[0])
        self.idf = idf
        self.names = [name for name, *_ in learned]
        self.centres = np.concatenate([np.zeros((0, DIMENSIONS), np.float32), *[c for _, c, *_ in learned]])
        self.owner = np.repeat(np.arange(len(learned)), [len(c) for _, c, *_ in learned])
        self.floor = floors([(sizes, cosines) for *_, sizes, cosines in learned])

    def predict(self, texts: list) -> list[list]:
        names, scores, rejected = ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
        index = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        if index and len(self.owner):
            for at in range(0, len(index), 64):
                part = index[at:at + 64]
                counted = np.stack([counts(texts[i]) for i in part])
                cosine = vectors(counted, self.idf) @ self.centres.T
                for i, c, x in zip(part, counted, cosine):
                    score = float(x.max())
                    owner = self.owner[x.argmax()]
                    names[i] = self.names[owner]
                    scores[i] = min(1.0, max(0.0, score))
                    rejected[i] = score < self.floor[owner, size(c)] or score <= 0
        return [names, scores, rejected]


def floors(found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Least cosine by language and size, from each language's sizes and cosines."""
    every = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0)] * 2

    def least(sizes: np.ndarray, cosines: np.ndarray, at: int) -> float | None:
        own = cosines[sizes == at]
        return REJECT_SHARE * float(np.quantile(own, REJECT_QUANTILE)) if len(own) >= REJECT_LEAST else None
    out = np.zeros((len(found), DIMENSIONS.bit_length() + 1))
    for at in range(1, out.shape[1]):  # a text of more n-grams is no further away than one of fewer
        shared = least(*every, at)
        for row, own in zip(out, found):
            known = [x for x in (least(*own, at), shared) if x is not None]
            row[at] = min(known) if known else row[at - 1]
    return out


def _kmeans(own: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Spherical k-means, started from points far from those picked before."""
    centres = own[rng.integers(len(own))][None]
    while len(centres) < k:
        far = (own @ centres.T).max(axis=1)
        centres = np.vstack([centres, own[far.argmin()][None]])
    for _ in range(15):
        near = (own @ centres.T).argmax(axis=1)
        centres = np.stack([unit(own[near == c].mean(axis=0)) if (near == c).any() else centres[c] for c in range(k)])
    return centres


def learn(spark: SparkSession, rows: DataFrame, text_col: str = "text", lang_col: str = "lang",
          sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from labelled rows (rows without language or letters are left out)."""
    rows = rows.select(F.col(f"`{text_col}`").cast("string").alias("text"),
                       F.col(f"`{lang_col}`").cast("string").alias("lang"))
    usable = rows.withColumn("h", F.xxhash64("text")).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # The sample is the least hashes of each language: first all under a bound that leaves four times the
    # sample, as a narrow table, then the least of those. The bound follows from about how many distinct
    # usable texts a language has: copies, null texts and those without letters do not count.
    n = F.col("n").cast("double")
    most = F.when(n <= 4 * sample_rows, F.lit(2**63 - 1)).otherwise(
        (F.lit(2.0**64 * 4 * sample_rows) / n - F.lit(2.0**63)).cast("long"))
    root = run_dir(spark, "langid")
    bounds = stored(usable.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
                    .select("lang", most.alias("most")), f"{root}/bounds")
    hashes = usable.join(bounded(bounds), "lang").where("h <= most").select("lang", "h").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    keys = stored(hashes.withColumn("rank", rank).where(F.col("rank") <= sample_rows).drop("rank"), f"{root}/keys")
    picked = usable.join(bounded(keys), ["lang", "h"]).dropDuplicates(["lang", "h"]).drop("h")

    def make() -> Callable:
        def run(texts: list) -> list[list]:
            pack = lambda t: np.minimum(counts(t), 65_535).astype(np.uint16).tobytes()
            return [[pack(t) for t in texts], [pack(piece(t)) for t in texts]]
        return run
    sample = stored(map_texts(picked, make, "counted binary, piece binary"), f"{root}/sample")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, present = 0, np.zeros(DIMENSIONS, np.int64)
        for batch in batches:
            for x in batch.column(0):
                n, present = n + 1, present + (np.frombuffer(x.as_buffer(), np.uint16) > 0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([present.tobytes()])], names=["n", "present"])
    n, present = 0, np.zeros(DIMENSIONS, np.int64)
    sums = stored(sample.select("counted").mapInArrow(add, "n long, present binary"), f"{root}/sums")
    for r in sums.toLocalIterator():  # a task's sum at a time
        n, present = n + r.n, present + np.frombuffer(r.present, np.int64)
    idf = np.log((1 + n) / (1 + present)).astype(np.float32) + np.float32(0.05)
    shared = spark.sparkContext.broadcast(idf)

    def train(own: pa.Table) -> pa.Table:
        own = own.sort_by("counted")  # the order of rows does not matter
        counted, pieces = (np.stack([np.frombuffer(x.as_buffer(), np.uint16) for x in own.column(c)])
                           for c in ("counted", "piece"))
        at = vectors(counted, shared.value)
        centres = _kmeans(at, min(CENTROIDS, len(at)), np.random.default_rng(SEED))
        cosines = np.concatenate([(x @ centres.T).max(axis=1) for x in (at, vectors(pieces, shared.value))])
        sizes = [size(c) for part in (counted, pieces) for c in part]
        return pa.table({"lang": own.column("lang").slice(0, 1).combine_chunks(), "centres": pa.array([centres.tobytes()], pa.binary()),
                         "sizes": pa.array([sizes], pa.list_(pa.int32())),
                         "cosines": pa.array([cosines.tolist()], pa.list_(pa.float64()))})
    learned = stored(sample.groupBy("lang").applyInArrow(
        train, "lang string, centres binary, sizes array<int>, cosines array<double>"), f"{root}/learned")
    return Model(idf, [(r.lang, np.frombuffer(r.centres, np.float32).reshape(-1, DIMENSIONS), np.array(r.sizes, np.int64),
                        np.array(r.cosines)) for r in learned.toLocalIterator()])


def piece(text: str) -> str:
    """Some words from the middle of a text, 1 to 512 of them by the text's checksum."""
    words = text.split()
    n = min(len(words), 1 << crc32(text.encode("utf-8", "surrogatepass")) % 10)
    at = (len(words) - n) // 2
    return " ".join(words[at:at + n])


def identify(spark: SparkSession, docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with lang_pred, score (cosine, 0 to 1) and rejected."""
    shared = spark.sparkContext.broadcast(model)

    def make() -> Callable:
        return shared.value.predict
    return map_texts(docs, make, "lang_pred string, score double, rejected boolean", text_col)


def keep_known(spark: SparkSession, docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the model rejects, all columns."""
    docs, file, row = located(docs)
    marked = identify(spark, docs.select(file.alias("file"), row.alias("row"), F.col(f"`{text_col}`").alias("text")), model)
    return drop_rows(docs, file, row, marked.where("rejected").select("file", "row"))
