"""Packing by power-of-two decomposition (operator 13).

A document of T tokens (its end mark included) is cut into T div ``longest``
pieces of ``longest`` tokens and one piece for each binary digit 1 of the
rest, longest first. So every piece has a power of two as its length and is a
sequence of its own: no sequence crosses documents and none is padded.
Sequences of equal length form a bucket; a training step takes its batch from
one bucket.

Texts are encoded whole. A text beyond ``STRETCH`` characters is encoded in
stretches cut between a letter and a space before another letter; the
tokenizer's own pattern always ends a match there, so the ids are the same
and memory holds one stretch's encoding. A stretch without such a place goes
on to the next.

A byte-level BPE file whose merges stand in the order of their ids is the same as
a table of ranks; stretches then go through the rank encoder, four times as
fast with the same ids. Other files, and stretches with very long runs of white space or beyond
twice the size (its matcher recurses), go through the file's own library.

Sequence numbers are dense, bucket by bucket from the longest. A number is the
count of pieces in the buckets before, of those in earlier ranges of a hash
(``RANGES`` counts a bucket) and the rank inside one range, so no order needs
one task. The hash takes a row's place in the input, so copies spread.

Defined cases: null text counts as empty; an empty text is its end mark alone
(one piece of length 1); repeated rows and null identifiers are packed like
others; a document of exactly ``longest`` tokens is one piece; an empty table
gives an empty result; other columns are left out, so their names can't clash.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Encoder

from ..session import run_dir
from .common import located, map_texts, stored

LONGEST, END_ID = 2048, 1
RANGES = 4096
STRETCH = 1 << 16
_BREAK = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")


def decompose(tokens: int, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of the pieces of ``tokens`` tokens; ``longest`` is a power of two."""
    full, rest = divmod(tokens, longest)
    digits = [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
    lengths = np.concatenate([np.full(full, longest, np.int64), np.array(digits, np.int64)])
    return np.cumsum(lengths) - lengths, lengths


def stretches(text: str, size: int = STRETCH) -> list[str]:
    """``text`` cut where the tokenizer's pattern ends a match in any case."""
    out, at = [], 0
    while len(text) - at > size:
        cut = _BREAK.search(text, at + size)
        if cut is None:
            break
        out.append(text[at:cut.start()])
        at = cut.start()
    return [*out, text[at:]]


def rank_table(file: dict) -> dict[bytes, int] | None:
    """The ranks of a tokenizer file, if ids are the ranks of plain byte-level BPE; else None."""
    model, pre = file["model"], file.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and not file.get("normalizer") and not any(
        model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"))
    if not plain:
        return None
    # bytes are written as letters: those that print as themselves, the others from U+0100 on
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    letters = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(own)))}
    vocab, last = model["vocab"], -1
    for merge in model["merges"]:
        made = vocab["".join(merge if isinstance(merge, list) else merge.split(" "))]
        if made <= last:
            return None
        last = made
    if len(vocab) != 256 + len(model["merges"]) or not all(set(t) <= set(letters) for t in vocab):
        return None
    return {bytes(letters[c] for c in token): k for token, k in vocab.items()}


_ENCODERS: dict[int, tuple[Encoder, tiktoken.Encoding | None]] = {}
_WIDE = re.compile(r"\s{2000}")


class Tokenizer:
    """A tokenizer file read on the driver and broadcast (a vocabulary has a fixed size, about 2 MB)."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
            data = f.read()
        self.key = zlib.crc32(data.encode())
        self.data = spark.sparkContext.broadcast(data)

    def encoders(self) -> tuple[Encoder, tiktoken.Encoding | None]:
        """Built once in each Python worker: the file's own encoder, and that of its ranks."""
        if self.key not in _ENCODERS:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            made = Encoder.from_str(self.data.value)
            made.encode_special_tokens = True
            made.no_truncation()
            made.no_padding()
            ranks = rank_table(json.loads(self.data.value))
            fast = ranks and tiktoken.Encoding(f"ranks-{self.key}", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                               special_tokens={})
            _ENCODERS.clear()
            _ENCODERS[self.key] = made, fast
        return _ENCODERS[self.key]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text, without the end mark."""
        own, fast = self.encoders()
        parts = []
        for stretch in stretches(text or ""):
            if fast and len(stretch) <= 2 * STRETCH and not _WIDE.search(stretch):
                parts.append(fast.encode_ordinary(stretch))
            else:
                parts.append(own.encode_batch_fast([stretch], add_special_tokens=False)[0].ids)
        return np.concatenate([np.array(p, np.uint32) for p in parts])


def pieces(docs: DataFrame, tokenizer: Tokenizer, text_col: str = "text", longest: int = LONGEST,
           end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """A row per piece: the columns of ``docs`` but the text, doc_tokens,
    start, length, ids_crc32 and, ``with_ids``, the ids as array<long>."""
    if longest < 1 or longest & longest - 1:
        raise ValueError("longest must be a power of two")

    def make():
        def run(texts: list) -> list[list]:
            rows = []
            for text in texts:
                ids = np.append(tokenizer.encode(text), np.uint32(end_id)).astype("<u4")
                starts, lengths = decompose(len(ids), longest)
                cut = [ids[a:a + n] for a, n in zip(starts.tolist(), lengths.tolist())]
                rows.append((len(ids), starts, lengths, [zlib.crc32(c.tobytes()) for c in cut])
                            + (([c.tolist() for c in cut],) if with_ids else ()))
            return [list(c) for c in zip(*rows)]
        return run

    carried = [c for c in docs.columns if c != text_col]
    schema = "doc_tokens long, start array<long>, length array<long>, ids_crc32 array<long>"
    names = ["start", "length", "ids_crc32"] + ["ids"] * with_ids
    out = map_texts(docs, make, schema + (", ids array<array<long>>" if with_ids else ""), text_col, slice_rows=32)
    return out.select(*[F.col(f"`{c}`") for c in carried], "doc_tokens", F.inline(F.arrays_zip(*names)))


def pack(spark: SparkSession, docs: DataFrame, tokenizer: Tokenizer, id_col: str = "doc_id", text_col: str = "text",
         longest: int = LONGEST, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """A row per piece: id, start, length, ids_crc32, doc_tokens, (ids,) sequence_id, offset (0: a piece fills its sequence)."""
    docs, file, row = located(docs)
    cut = pieces(docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(file, row).alias("h"),
                             F.col(f"`{text_col}`").alias("text")), tokenizer, "text", longest, end_id, with_ids)
    cut = cut.withColumn("h", F.xxhash64("h", "start"))
    cut = stored(cut.withColumn("range", F.pmod("h", F.lit(RANGES)).cast("int")), f"{run_dir(spark, 'packing')}/pieces")
    counts = cut.groupBy("length", "range").agg(F.count(F.lit(1)).alias("n"))  # RANGES a bucket at most
    order = Window.orderBy(F.col("length").desc(), "range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "range", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "range").orderBy("h")
    placed = cut.withColumn("place", F.row_number().over(inside)).join(F.broadcast(before), ["length", "range"])
    return placed.select("id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids,
                         (F.col("before") + F.col("place") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def write_buckets(packed: DataFrame, path: str) -> None:
    """Sequences as Parquet, one folder a length (``length=2048`` ...), so that a training step reads one bucket."""
    packed.write.partitionBy("length").parquet(path)
