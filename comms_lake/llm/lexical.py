"""Ranked lexical search with geometrically blocked posting lists (operator 11).

Model. A text's terms are runs of letters, digits and code points from U+0080
on (A-Z lower-cased). A document's score for a query is the sum over the
query's terms, repeats included, of weight times impact, all in 64-bit
integers: ``weight`` falls with the documents that hold a term, ``impact`` grows with
its occurrences and falls with the document's length.

Index. Documents become sparse vectors over the terms of the query set and go
to shards: the cell of the nearest of ``CELLS`` centroids (cosine of hashed projections), cut by
hash into parts of about ``ENTRIES`` coordinates, so that a cell with most
documents is many shards. In a shard each term has a posting list; the list is
clustered by document similarity into blocks of about ``BLOCK`` documents, and
a block has a summary: the greatest impact of each coordinate over its
documents, rounded up to 8 bits. Lists are blocked when first used.

Search. A query opens its terms' lists from the greatest possible contribution down.
Weights times a summary bound every document of a block; a block is
skipped only if that bound is below the score of the query's k-th
document so far, and the remaining lists only if their greatest impacts together are. The
first threshold is the k-th score among ``SAMPLE`` documents, an exact lower
bound. Documents of other blocks get their exact score from their vector. So
results are exact; sample, centroids and clusters change the speed alone. A
shard gives k rows a query, and the best k of those are taken in two steps.

Queries. They come in blocks of about ``QUERY_BYTES`` of text, each a pass over
the documents; a block's vocabulary bounds vectors, summaries and broadcasts.

Defined cases: null and empty texts have no term, are not counted and never
found; a query without terms gives no row; equal scores rank by identifier
(null last); repeated rows are documents of their own, repeated queries are
answered each; an empty table gives an empty result; other columns aren't read,
so their names can't clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import run_dir
from .common import stored

TOP = 20
SCALE, B = 1000, 25            # of a weight; percent of the length in an impact
QUERY_BYTES = 1 << 16          # of the queries that are searched together
CELLS, DIMS, SAMPLE = 64, 48, 4096
SAMPLE_ENTRIES = 1 << 21       # coordinates that the sample may have on the driver
ENTRIES, BLOCK = 1 << 19, 128  # coordinates of a shard; documents of a block
SALTS = 256
SEED = 11

# ASCII digits and letters stay (A-Z lower-cased), other ASCII becomes a space; bytes from 0x80 on belong to terms
_TERMS = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERMS).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """n: the terms of each entry's document."""
    m = 100 - B + (B * n * n_docs) // total
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def vectors(docs: DataFrame, vocabulary: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, at, tf) of every document with a term: its length, its terms of ``vocabulary`` by
    number (ascending) and their occurrences. ``vocabulary`` is broadcast; its size is bounded by the query block."""
    number = docs.sparkSession.sparkContext.broadcast({w: k for k, w in enumerate(vocabulary)})
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.value
        ints = pa.list_(pa.int32())
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                size, at, tf = [], [], []
                for text in batch.column(1):
                    found = terms(text.as_py())
                    mine = sorted((known[w], c) for w, c in Counter(found).items() if w in known)
                    size.append(len(found))
                    at.append([k for k, _ in mine])
                    tf.append([c for _, c in mine])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(size, pa.int64()), pa.array(at, ints), pa.array(tf, ints)],
                    names=["id", "n", "at", "tf"]).filter(pa.array([s > 0 for s in size], pa.bool_()))

    return texts.mapInArrow(run, f"id {kind}, n long, at array<int>, tf array<int>")


class Rows:
    """Documents as one sparse matrix; coordinates are numbers of the query block's vocabulary."""

    def __init__(self, table: pa.Table, n_docs: int, total: int):
        at, tf = (table.column(c).combine_chunks() for c in ("at", "tf"))
        self.size = np.diff(np.asarray(at.offsets)).astype(np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.at = np.asarray(at.flatten()).astype(np.int64)
        long = np.repeat(np.asarray(table.column("n")), self.size)
        self.impact = impacts(np.asarray(tf.flatten()).astype(np.int64), long, n_docs, total)

    def entries(self, docs: np.ndarray) -> np.ndarray:
        """Places of the entries of ``docs``, one document after the other."""
        size = self.size[docs]
        return np.repeat(self.start[docs] - np.cumsum(size) + size, size) + np.arange(size.sum())

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores; ``weights`` is dense over the vocabulary."""
        places = self.entries(docs)
        sums = np.concatenate([[0], np.cumsum(self.impact[places] * weights[self.at[places]])])
        ends = np.cumsum(self.size[docs])
        return sums[ends] - sums[ends - self.size[docs]]

    def projected(self, weights: np.ndarray) -> np.ndarray:
        """Weighted vectors hashed to ``DIMS`` signed dimensions, of unit length."""
        slot = (self.at * 2_654_435_761 >> 7) % DIMS
        sign = 1 - 2 * (self.at * 2_246_822_519 >> 11 & 1)
        of = np.repeat(np.arange(len(self.size)), self.size)
        value = sign * self.impact * weights[self.at]
        out = np.bincount(of * DIMS + slot, value, len(self.size) * DIMS).reshape(-1, DIMS)
        return (out / np.maximum(1, np.linalg.norm(out, axis=1, keepdims=True))).astype(np.float32)


def clustered(points: np.ndarray, k: int, rounds: int = 3) -> np.ndarray:
    """Centroids of a few rounds of spherical k-means from spread-out points."""
    rng = np.random.default_rng(SEED)
    if len(points) == 0:
        return np.zeros((1, DIMS), np.float32)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        own = np.argmax(points @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.maximum(length, 1e-9), centres)
    return centres


class Shard:
    """Posting lists over the documents of a shard, in blocks with summaries."""

    def __init__(self, rows: Rows, weights: np.ndarray):
        self.rows = rows
        self.points = rows.projected(weights)
        order = np.argsort(rows.at, kind="stable")
        self.coords, begin = np.unique(rows.at[order], return_index=True)  # the shard's own coordinates
        self.begin = np.append(begin, len(order))
        self.posting = np.repeat(np.arange(len(rows.size)), rows.size)[order]
        self.local = np.searchsorted(self.coords, rows.at)
        self.greatest = np.maximum.reduceat(rows.impact[order], begin) if len(order) else np.zeros(0, np.int64)
        self.unit = max(1, -(-int(self.greatest.max(initial=0)) // 255))
        self.lists: dict[int, tuple] = {}

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents by block, block starts, summaries) of the posting list of ``coords[term]``."""
        if term not in self.lists:
            docs = self.posting[self.begin[term]:self.begin[term + 1]]
            count = -(-len(docs) // BLOCK)
            if count > 1:
                points = self.points[docs]
                own = np.argmax(points @ clustered(points, count, 1).T, axis=1)
                order = np.argsort(own, kind="stable")
                docs, own = docs[order], own[order]
            else:
                own = np.zeros(len(docs), np.int64)
            starts = np.flatnonzero(np.diff(own, prepend=-1))
            block = np.cumsum(np.diff(own, prepend=own[0]) > 0)
            places = self.rows.entries(docs)
            width = len(self.coords)
            summary = np.zeros(len(starts) * width, np.int64)
            np.maximum.at(summary, np.repeat(block, self.rows.size[docs]) * width + self.local[places],
                          self.rows.impact[places])
            summary = (-(-summary // self.unit)).astype(np.uint8).reshape(-1, width)
            self.lists[term] = docs, np.append(starts, len(docs)), summary
        return self.lists[term]

    def search(self, at: np.ndarray, value: np.ndarray, dense: np.ndarray, top: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``top`` (documents, scores) with ``least`` or more; equal scores by document number.
        ``value`` is the weight, repeats included, of the query's terms ``at``; ``dense`` the same by number."""
        here = np.searchsorted(self.coords, at)
        inside = (here < len(self.coords)) & (self.coords[np.minimum(here, len(self.coords) - 1)] == at)
        here, value = here[inside], value[inside]
        most = value * self.greatest[here]
        order = np.argsort(-most, kind="stable")
        rest = np.cumsum(most[order][::-1])[::-1]  # what this list and those after it can give
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        seen = np.zeros(len(self.rows.size), bool)
        for term, left in zip(here[order].tolist(), rest.tolist()):
            if left < least:
                break
            listed, starts, summary = self.blocks(term)
            bound = (summary[:, here].astype(np.int64) @ value) * self.unit
            for block in np.argsort(-bound, kind="stable").tolist():
                if bound[block] < least:
                    break
                new = listed[starts[block]:starts[block + 1]]
                new = new[~seen[new]]
                if not len(new):
                    continue
                seen[new] = True
                docs = np.concatenate([docs, new])
                scores = np.concatenate([scores, self.rows.scores(new, dense)])
                best = np.lexsort((docs, -scores))[:top]
                docs, scores = docs[best], scores[best]
                if len(best) == top:
                    least = max(least, int(scores[-1]))
        return docs[scores >= least], scores[scores >= least]


class Queries:
    """A block of queries and, once counted, the corpus figures: what tasks need, in one broadcast."""

    def __init__(self, texts: list, numbers: list[int]):
        bags = [Counter(terms(t)) for t in texts]
        self.vocabulary = sorted(set().union(*bags))
        place = {w: k for k, w in enumerate(self.vocabulary)}
        self.numbers = numbers
        self.bags = [(np.array(sorted(place[w] for w in bag), np.int64), bag) for bag in bags]
        self.bags = [(at, np.array([bag[self.vocabulary[k]] for k in at], np.int64)) for at, bag in self.bags]

    def weigh(self, n_docs: int, total: int, df: np.ndarray) -> None:
        self.n_docs, self.total = n_docs, total
        self.weights = np.array([weight(n_docs, int(d)) for d in df], np.int64)

    def each(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(place, terms, values, dense values) of each query with a term that counts."""
        for k, (at, repeats) in enumerate(self.bags):
            value = repeats * self.weights[at]
            at, value = at[value > 0], value[value > 0]
            if len(at):
                dense = np.zeros(len(self.vocabulary), np.int64)
                dense[at] = value
                yield k, at, value, dense

    def fit(self, sample: pa.Table, top: int) -> None:
        """Centroids and first thresholds from a sample."""
        rows = Rows(sample, self.n_docs, self.total)
        self.centres = clustered(rows.projected(self.weights), CELLS)
        self.least = np.ones(len(self.bags), np.int64)  # a score of 0 is no result
        every = np.arange(len(rows.size))
        if len(every) >= top:
            for k, _, _, dense in self.each():
                self.least[k] = max(1, np.partition(rows.scores(every, dense), -top)[-top])


def _search_block(spark: SparkSession, docs: DataFrame, block: Queries, top: int, id_col: str, text_col: str,
                  root: str, entries: int) -> DataFrame:
    """(query, id, score): the best ``top`` documents of every shard."""
    rows = stored(vectors(docs, block.vocabulary, id_col, text_col), f"{root}/vectors")
    kind = rows.schema["id"].dataType.simpleString()
    n_docs, total = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
    held = rows.select(F.explode("at").alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("df")).toArrow()
    df = np.zeros(len(block.vocabulary), np.int64)
    df[held.column("at").to_numpy()] = held.column("df").to_numpy()
    block.weigh(n_docs, max(1, total or 0), df)
    share = max(1, n_docs and int(held.column("df").to_numpy().sum()) // n_docs)  # coordinates of a document on average
    picked = rows.orderBy(F.xxhash64("id", "n"), "id").limit(max(top, min(SAMPLE, SAMPLE_ENTRIES // share)))
    block.fit(picked.select("n", "at", "tf").toArrow(), top)
    shared = spark.sparkContext.broadcast(block)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                batch = whole.slice(start, 2048)
                part = Rows(pa.Table.from_batches([batch]), queries.n_docs, queries.total)
                cell = np.argmax(part.projected(queries.weights) @ queries.centres.T, axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], names=[*batch.schema.names, "cell"])

    def search(table: pa.Table) -> pa.Table:
        queries = shared.value
        table = table.sort_by("id").combine_chunks()  # so that document numbers go by identifier, null last
        shard = Shard(Rows(table, queries.n_docs, queries.total), queries.weights)
        found = [(k, *shard.search(at, value, dense, top, int(queries.least[k]))) for k, at, value, dense in queries.each()]
        query, which, score = ([] for _ in range(3)) if not found else zip(*(
            (np.full(len(d), queries.numbers[k]), d, s) for k, d, s in found))
        query, which, score = (np.concatenate(x).astype(np.int64) if len(x) else np.zeros(0, np.int64) for x in (query, which, score))
        return pa.table({"query": query, "id": table.column("id").take(pa.array(which)), "score": score})

    cells = stored(rows.mapInArrow(assign, f"id {kind}, n long, at array<int>, tf array<int>, cell int"), f"{root}/cells")
    place = F.xxhash64("_metadata.file_name", "_metadata.row_index")  # of the stored row, so repeated rows spread
    parts = cells.groupBy("cell").agg(F.ceil(F.sum(F.size("at")) / entries).alias("parts"))  # CELLS rows
    return (cells.withColumn("place", place).join(F.broadcast(parts), "cell")
            .withColumn("part", F.pmod("place", F.greatest("parts", F.lit(1))))
            .groupBy("cell", "part").applyInArrow(search, f"query long, id {kind}, score long"))


def search(spark: SparkSession, docs: DataFrame, queries: DataFrame, top: int = TOP, id_col: str = "doc_id",
           text_col: str = "text", query_id: str = "item_id", query_text: str = "text", entries: int = ENTRIES,
           query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(query_id, rank from 1, id, score): the ``top`` documents with the highest score above 0 of each query."""
    root = run_dir(spark, "lexical")
    text = F.coalesce(F.col(f"`{query_text}`").cast("string"), F.lit(""))
    asked = stored(queries.select(F.col(f"`{query_id}`").alias("query_id"), text.alias("text"))
                   .withColumn("query", F.monotonically_increasing_id()), f"{root}/queries")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // query_bytes))
    found = []
    for number in range(count):  # one pass over the documents each
        part = asked.where(F.pmod(F.xxhash64("query"), F.lit(count)) == number).select("query", "text").orderBy("query").toArrow()
        block = Queries(part.column("text").to_pylist(), part.column("query").to_pylist())
        hits = _search_block(spark, docs, block, top, id_col, text_col, f"{root}/block-{number}", entries)
        found.append(stored(hits, f"{root}/found-{number}"))
    hits = reduce(DataFrame.unionByName, found)
    by = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    salted = Window.partitionBy("query", "salt").orderBy(*by)
    some = (hits.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
            .withColumn("place", F.row_number().over(salted)).where(F.col("place") <= top))
    best = (some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*by))).where(F.col("rank") <= top))
    names = asked.select("query", "query_id")
    return best.join(names, "query").select("query_id", "rank", "id", "score")
