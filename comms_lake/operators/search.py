"""phrase search over a positional inverted index.

A batch of documents adds postings (term, id, field, positions), one row a term
and field of a document, in folders by batch and by a hash of the term, and the
terms it has. A phrase reads the folders of its own terms alone. A phrase
matches as text does, so its first word may be the end of a term and its last
word the beginning of one: those are looked up among the terms first.
Documents whose positions line up are compared with the phrase itself, so
what stands between the words counts as well, and results equal the scan's.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import bounded, materialize

BUCKETS = 64
WORDS = 1 << 20  # words that are grouped at once, beyond one text
LISTED = 1000  # terms that a filter lists; more are joined
POSTINGS = "term string, id string, field string, positions array<int>, batch int, bucket int"
TERMS = "term string, batch int, bucket int"
# --- fixed value: what separates terms ---
BETWEEN = r"[^\p{L}\p{N}]+"


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, field, words) as rows (term, id, field, positions): a text's own words are
    grouped where the text is, some ``WORDS`` words at a time."""
    for batch in batches:
        ends = np.cumsum(pc.list_value_length(batch["words"]).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            until = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + WORDS, "right")))
            part = batch.slice(first, until - first)
            row = pc.list_parent_indices(part["words"])
            starts = np.concatenate([[0], np.cumsum(pc.list_value_length(part["words"]).to_numpy(zero_copy_only=False))])
            at = np.arange(len(row)) - starts[row.to_numpy(zero_copy_only=False)]
            words = pa.table({"row": row, "term": pc.list_flatten(part["words"]), "position": pa.array(at, pa.int32())})
            of = words.group_by(["row", "term"], use_threads=False).aggregate([("position", "list")])  # in order
            yield from pa.table({"term": of["term"], "id": part["id"].take(of["row"].combine_chunks()),
                                 "field": part["field"].take(of["row"].combine_chunks()), "positions": of["position_list"]}).to_batches()
            first = until


def add_batch(docs: DataFrame, path: str, batch: int, fields: tuple[str, ...] = ("subject", "body")) -> None:
    """Postings of the documents (``id`` and text ``fields``) of a batch; a
    batch that is added again is replaced. The one shuffle is that of whole postings to their folders."""
    text = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.lower(X.s(f)).alias("text")) for f in fields]))
    words = docs.select(F.col("id").cast("string").alias("id"), text.alias("t")).select(
        "id", "t.field", F.filter(F.split("t.text", BETWEEN), lambda w: w != "").alias("words"))
    rows = (words.mapInArrow(_positions, "term string, id string, field string, positions array<int>")
            .withColumn("bucket", _bucket(F.col("term"))))
    here = os.path.join(path, "postings", f"batch={batch}")
    (rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(here))
    (rows.sparkSession.read.parquet(here).select("term", "bucket").distinct().hint("rebalance", "bucket")
     .write.mode("overwrite").partitionBy("bucket").parquet(os.path.join(path, "terms", f"batch={batch}")))


def _matching(terms: DataFrame, words: list[str], at: int) -> DataFrame:
    """Terms that the phrase's word ``at`` may be in."""
    first, last = at == 0, at == len(words) - 1
    term, word = F.col("term"), F.lit(words[at])
    how = F.contains(term, word) if first and last else F.endswith(term, word) if first else F.startswith(term, word) if last else term == word
    where = terms if first or last else terms.where(F.col("bucket") == _bucket(word))
    return where.where(how).select("term").distinct()


def postings_of(spark: SparkSession, path: str, words: list[str], at: int) -> DataFrame:
    """(id, field, start): where the phrase would begin for its word ``at`` to be here. Only the
    folders of the word's terms are read."""
    table = spark.read.schema(POSTINGS).parquet(os.path.join(path, "postings"))
    if 0 < at < len(words) - 1:
        found = table.where((F.col("bucket") == _bucket(F.lit(words[at]))) & (F.col("term") == words[at]))
    else:
        terms = materialize(_matching(spark.read.schema(TERMS).parquet(os.path.join(path, "terms")), words, at), "terms")
        few = [r.term for r in terms.limit(LISTED + 1).collect()]  # LISTED words at most
        if len(few) <= LISTED:
            buckets = [r.b for r in terms.select(_bucket(F.col("term")).alias("b")).distinct().collect()]  # BUCKETS numbers at most
            found = table.where(F.col("bucket").isin(buckets) & F.col("term").isin(few))
        else:
            found = table.join(bounded(terms), "term", "left_semi")
    return found.select("id", "field", F.explode(F.transform("positions", lambda p: p - at)).alias("start")).distinct()


def search(docs: DataFrame, path: str, phrase: str) -> DataFrame:
    """The rows of ``docs`` (``id`` and the indexed fields) that hold the phrase, whatever the case."""
    spark, phrase = docs.sparkSession, phrase.lower()
    words = [w for w in re.split(r"(?:[^\w]|_)+", phrase) if w]
    if not words:
        raise ValueError("a phrase needs a word")
    places = None
    for at in range(len(words)):
        here = postings_of(spark, path, words, at)
        places = here if places is None else places.join(here, ["id", "field", "start"], "left_semi")
    places = materialize(places.select("id", "field").distinct(), "places")  # read twice
    wanted = places.groupBy("id").agg(F.collect_set("field").alias("__fields"))
    fields = [r.field for r in places.select("field").distinct().collect()]  # the names of the indexed fields
    rows = docs.join(wanted.withColumnRenamed("id", "__id"), F.col("id").cast("string") == F.col("__id"))
    hit = F.lit(False)
    for f in fields:
        hit = hit | (F.array_contains("__fields", f) & F.contains(F.lower(X.s(f)), F.lit(phrase)))
    return rows.where(hit).drop("__id", "__fields")
