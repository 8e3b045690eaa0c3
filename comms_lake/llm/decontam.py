"""Benchmark decontamination (operator 4).

Test items are normalised to words and cut into windows of ``window`` words
(an item of fewer words is one window). One Aho-Corasick automaton holds all
windows; each document is normalised the same way and scanned once. Matches
map back to word numbers and to character offsets of the original text.

The test set is a query set against all rows: its windows are broadcast in
blocks of at most ``block_bytes`` of text (counted first), one scan a block,
and the blocks' hits are merged per document.

Defined cases: null text has no words; items without words are no windows;
items with a null identifier are left out; the windows of rows that repeat an
identifier count for that item; repeated documents are reported each; a
document without hits has the digest of the empty list; empty tables (either)
give no hits or no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_rows, fresh, located, map_texts

WINDOW = 13
BLOCK_BYTES = 2 << 20  # of item text; a word begins a window, so patterns are some 13 times as much
# UTF-8 bytes of words; A-Z become a-z and any other byte becomes a space.
_WORD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD).split()


def windows(item_words: list[bytes], window: int) -> Iterator[bytes]:
    """Each window as its words, every one followed by a space."""
    if item_words:
        for i in range(max(1, len(item_words) - window + 1)):
            yield b"".join(w + b" " for w in item_words[i:i + window])


class Automaton:
    """Windows of some items, ready to scan word streams. Patterns and texts
    are bytes read as Latin-1, a space on either side of each word."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        found: dict[bytes, set[str]] = {}
        for item, data in items:
            for w in windows(data.split(), window):
                found.setdefault(w, set()).add(item)
        self.machine = ahocorasick.Automaton()
        for w, ids in found.items():
            self.machine.add_word((b" " + w).decode("latin-1"), (w.count(b" "), tuple(ids)))
        self.empty = not found
        if not self.empty:
            self.machine.make_automaton()

    def scan(self, doc_words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans (first, end) of all windows that occur, and their items."""
        if self.empty or not doc_words:
            return [], set()
        stream = (b" " + b" ".join(doc_words) + b" ").decode("latin-1")
        spans, items, ends = [], set(), None
        for at, (length, ids) in self.machine.iter(stream):
            if ends is None:
                ends = np.cumsum([len(w) + 1 for w in doc_words])  # place of the space after each word
            last = int(np.searchsorted(ends, at)) + 1
            spans.append((last - length, last))
            items.update(ids)
        return spans, items


_MACHINES: dict[str, Automaton] = {}


def machine_of(key: str, items: list[tuple[str, bytes]], window: int) -> Automaton:
    """A block's automaton, built once in each Python worker; the last one is kept."""
    if key not in _MACHINES:
        _MACHINES.clear()
        _MACHINES[key] = Automaton(items, window)
    return _MACHINES[key]


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, with overlapping and touching spans joined."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def word_offsets(text: str) -> list[tuple[int, int]]:
    """Character offsets (start, end) of each word in the original text."""
    out, start = [], None
    for i, c in enumerate(text):
        inside = ord(c) >= 128 or _WORD[ord(c)] != 32
        if inside and start is None:
            start = i
        elif not inside and start is not None:
            out.append((start, i))
            start = None
    return out + ([(start, len(text))] if start is not None else [])


def _blocks(bench: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """Items as (identifier, normalised text) in lists of at most ``block_bytes`` (or one item)."""
    items = bench.select(F.col(f"`{id_col}`").cast("string").alias("item"),
                         F.col(f"`{text_col}`").cast("string").alias("text")).where("item is not null")
    block, held = [], 0
    for row in items.toLocalIterator():
        data = b" ".join(words(row.text))
        if block and held + len(data) > block_bytes:
            yield block
            block, held = [], 0
        block.append((row.item, data))
        held += len(data)
    yield block


def contamination(spark: SparkSession, docs: DataFrame, bench: DataFrame, text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES, share: int = 20) -> DataFrame:
    """``docs`` without its text, with n_words, n_hit, items (sorted
    identifiers), spans (``start:end`` character offsets of the hit passages)
    and contaminated (any hit, and n_hit is at least a ``share``-th of the words)."""
    hits, items = fresh(docs, "hits"), fresh(docs, "found_items")
    out = docs.withColumns({hits: F.array().cast("array<long>"), items: F.array().cast("array<string>")})
    blocks = _blocks(bench, item_id_col, item_text_col, block_bytes)
    block, more = next(blocks), True
    while more:
        shared, block = spark.sparkContext.broadcast(block), next(blocks, None)
        more = block is not None

        def make(shared=shared, last=not more, key=uuid.uuid4().hex) -> Callable:
            machine = machine_of(key, shared.value, window)

            def scan(texts: list, before: list, found: list) -> list[list]:
                rows = []
                for text, old, ids in zip(texts, before, found):
                    doc_words = words(text)
                    spans, new = machine.scan(doc_words)
                    spans = merge([*zip(old[::2], old[1::2]), *spans])
                    ids = sorted({*ids, *new})
                    if not last:
                        rows.append(([x for s in spans for x in s], ids))
                        continue
                    places = word_offsets(text) if spans else []
                    rows.append((len(doc_words), sum(b - a for a, b in spans), ids,
                                 [f"{places[a][0]}:{places[b - 1][1]}" for a, b in spans]))
                return [list(c) for c in zip(*rows)]
            return scan
        schema = (f"`{hits}` array<long>, `{items}` array<string>" if more else
                  "n_words long, n_hit long, items array<string>, spans array<string>")
        out = map_texts(out, make, schema, text_col, state=(hits, items), keep_text=more)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def keep_clean(spark: SparkSession, docs: DataFrame, bench: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated rows, all columns."""
    docs, file, row = located(docs)
    marked = contamination(spark, docs.select(file.alias("file"), row.alias("row"),
                                              F.col(f"`{text_col}`").alias("text")), bench)
    return drop_rows(docs, file, row, marked.where("contaminated").select("file", "row"))
