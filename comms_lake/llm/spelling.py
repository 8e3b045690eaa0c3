"""Spelling variants by search schemes on bidirectional FM-indexes (operator 12).

Words. Each maximal run of letters up to U+00FF gives a word (A-Z lower-cased;
where ``every`` divides the CRC-32 of ``<id>:<run>``, one code point goes).
A task counts its words before the shuffle. All code points fit in a byte, so
a word is its Latin-1 bytes and byte order is code-point order.

Search. Two words are near if one insertion, deletion or replacement makes
them equal. A word of m code points is cut in halves; a near word holds one
half exactly. Scheme 0 matches the left half, then extends to the right with
one error; scheme 1 mirrors it. A shard holds an FM-index of its delimited
words and one of the words reversed. The exact half is matched from the
middle outwards up to the delimiter, and each step updates the interval of
suffix ranks in both indexes; the search then goes on in the other direction
from that second interval. A near word that both schemes find counts in
scheme 0 alone, so counts need no pairs outside the shard.

Shards. A word goes, for each length m that a query near it can have, to the
two keys (m, its exact part), so a query meets all near words under its own
two keys. Keys are dealt to shards of about ``SYMBOLS`` symbols by hash. A key
with more than that is split: its erroneous part is halved again, which gives
two keys with a longer exact part (at the front, or at both ends). The
recursion ends at ``FEW`` words, or at one code point of error, where a key has
a few thousand words at most; so there is no cap on partners. No shard returns
pairs: it gives each query's count of near words and the best of them. Words
beyond ``LONG`` code points match ``LONG`` / 2 of them in the index and are then
compared as a whole with the words of that interval.

Roots. Forms strictly grow in ``n``, so chains end; they are followed by
pointer jumping, each round a written table.

Defined cases: null and empty texts have no word; a null identifier is the
empty string in the checksum; a word of any length is a word; equal counts
choose the smallest form in code-point order; repeated rows count as rows; an
empty table gives an empty result; other columns aren't read, so their names
can't clash.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import bounded, run_dir
from .common import stored

EVERY, MIN_CHARS, MIN_COUNT = 97, 5, 3
SYMBOLS = 1 << 17  # of a shard's words, delimiters included
FLUSH = 1 << 18    # distinct words that a counting task holds
QUERIES = 4096     # searched together in a shard
STEP = 64          # rows between two checkpoints of an index
FEW, LONG = 16, 256

# letters stay (A-Z lower-cased), all else becomes a space; code points beyond U+00FF arrive as '?'
_LETTERS = bytes(i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i >= 0xC0 else 32 for i in range(256))


def runs(text: str | None) -> list[bytes]:
    """Lower-cased letter runs as Latin-1 bytes."""
    return (text or "").encode("latin-1", "replace").translate(_LETTERS).split()


def spelled(run: bytes, start: int, every: int = EVERY) -> bytes:
    """The word of a run; ``start`` is the CRC-32 of what stands before it."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = EVERY,
          min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all words with ``min_chars`` code points and ``min_count`` occurrences."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(list(total.values()), pa.int64())],
                names=["word", "n"])
            total.clear()
            return batch

        for batch in batches:
            for at in range(batch.num_rows):
                start = zlib.crc32(f"{batch.column(0)[at].as_py() or ''}:".encode())
                for run, n in Counter(runs(batch.column(1)[at].as_py())).items():
                    word = spelled(run, start, every)
                    if len(word) >= min_chars:
                        total[word] += n
                if len(total) > FLUSH:
                    yield out()
        yield out()

    texts = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return (texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions of ``text`` (words, each ended by a 0) by their suffix up to the 0; equal ones by position."""
    n = len(text)
    ends = np.flatnonzero(text == 0)
    left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)  # symbols before the 0
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | np.where(left > k, padded[k:k + n], 0).astype(np.uint64)
    width = 8
    while True:
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], key[order[1:]] != key[order[:-1]]])
        group = np.cumsum(new) - 1
        tied = np.bincount(group)[group] > 1
        if not (tied & (left[order] >= width)).any():
            return order
        rank = np.empty(n, np.int64)
        rank[order] = group + 1
        later = np.where(left >= width, rank[np.minimum(np.arange(n) + width, n - 1)], 0)
        key = rank * (n + 1) + later
        width *= 2


class Index:
    """FM-index of sorted distinct words: the transformed text, the rank step and counts of smaller symbols."""

    def __init__(self, sorted_words: list[bytes]):
        text = np.frombuffer(b"\0".join(sorted_words) + b"\0", np.uint8)
        self.n = n = len(text)
        self.bwt = text[suffix_order(text) - 1]
        by = np.argsort(self.bwt, kind="stable")
        self.keys = self.bwt[by].astype(np.int64) * n + by
        blocks = n // STEP + 1
        counts = np.bincount(np.arange(n) // STEP * 256 + self.bwt, minlength=blocks * 256).reshape(blocks, 256)
        before = np.cumsum(counts, axis=0) - counts
        self.less = (np.cumsum(before, axis=1) - before).astype(np.int32)
        self.rows = np.concatenate([self.bwt, np.zeros(blocks * STEP - n, np.uint8)]).reshape(blocks, STEP)

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The first row that begins with ``symbol`` and whose rest is at row ``at`` or later."""
        return np.searchsorted(self.keys, symbol * np.int64(self.n) + at)

    def smaller(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Symbols smaller than ``symbol`` in the rows before ``at``."""
        block, rest = at // STEP, at % STEP
        inside = (self.rows[block] < symbol[:, None]) & (np.arange(STEP) < rest[:, None])
        return self.less[block, symbol] + inside.sum(axis=1)

    def branches(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(state, symbol, lo, hi) of every symbol that extends a state. States are of one
        length, so different intervals do not overlap and all together span ``n`` rows at most."""
        starts, first, of = np.unique(lo, return_index=True, return_inverse=True)
        size = hi[first] - starts
        rows = np.repeat(starts - np.cumsum(size) + size, size) + np.arange(size.sum())
        found = np.unique(np.repeat(np.arange(len(starts)), size) * 256 + self.bwt[rows])
        found = found[found % 256 > 0]
        which, symbol = found // 256, found % 256
        low, high = self.step(symbol, starts[which]), self.step(symbol, hi[first][which])
        begin = np.searchsorted(which, np.arange(len(starts) + 1))
        many = np.diff(begin)[of]
        child = np.repeat(begin[of] - np.cumsum(many) + many, many) + np.arange(many.sum())
        return np.repeat(np.arange(len(lo)), many), symbol[child], low[child], high[child]


def _search(first: Index, then: Index, patterns: np.ndarray, head: int, tail: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, rank) of words one error from a pattern, none of it in its first ``head`` or last
    ``tail`` symbols; ranks are those of ``then``. Rows of ``patterns`` are of one length."""
    count, length = patterns.shape
    symbols = patterns.astype(np.int64)
    lo, hi, other = np.zeros(count, np.int64), np.full(count, first.n), np.zeros(count, np.int64)
    for j in range(head - 1, -2, -1):  # outwards, up to the delimiter; both intervals
        c = symbols[:, j] if j >= 0 else np.zeros(count, np.int64)
        other += first.smaller(c, hi) - first.smaller(c, lo)
        lo, hi = first.step(c, lo), first.step(c, hi)
    exact = (np.arange(count), other, other + hi - lo)
    exact = tuple(x[hi > lo] for x in exact)
    wrong = tuple(np.zeros(0, np.int64) for _ in range(3))

    def extended(states: tuple, j: int) -> tuple:
        q, low, high = states
        c = symbols[q, j]
        low, high = then.step(c, low), then.step(c, high)
        return tuple(x[high > low] for x in (q, low, high))

    for j in range(head, length + 1):
        later = []
        if j <= length - tail and len(exact[0]):
            state, c, low, high = then.branches(exact[1], exact[2])
            q = exact[0][state]
            wrong = tuple(np.concatenate(x) for x in zip(wrong, (q, low, high)))  # a symbol more
            if j < length - tail:
                other_symbol = c != symbols[q, j]
                later = [tuple(x[other_symbol] for x in (q, low, high)), exact]   # another symbol, a symbol less
        if j < length:
            exact, wrong = extended(exact, j), extended(wrong, j)
            wrong = tuple(np.concatenate(x) for x in zip(wrong, *later))
            once = np.unique(wrong[0] * (then.n + 1) + wrong[1], return_index=True)[1]  # repeated symbols lead to one state
            wrong = tuple(x[once] for x in wrong)
    low, high = (then.step(np.int64(0), x) for x in wrong[1:])
    pairs = np.unique(wrong[0][high > low] * then.n + low[high > low])
    return pairs // then.n, pairs % then.n


def one_error(a: bytes, b: bytes) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    m = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(a, np.uint8, m) != np.frombuffer(b, np.uint8, m))
    at = int(differ[0]) if len(differ) else m
    return a[at + (len(a) >= len(b)):] == b[at + (len(b) >= len(a)):]


def _compared(index: Index, ids: np.ndarray, vocabulary: list[bytes], group: list[bytes], exact: int,
              turn: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) of long words: those that begin (``turn`` 1) or end (-1) alike, compared as a whole."""
    q, found = [], []
    for k, word in enumerate(group):
        lo, hi = np.int64(0), np.int64(index.n)
        for c in [*word[::turn][:min(exact, LONG // 2)][::-1], 0]:
            lo, hi = index.step(np.int64(c), lo), index.step(np.int64(c), hi)
        near = [i for i in ids[lo:hi].tolist() if one_error(word, vocabulary[i])]
        q += [k] * len(near)
        found += near
    return np.array(q, np.int64), np.array(found, np.int64)


def parts(length: int, path: str) -> tuple[int, int, list[tuple[int, int]]]:
    """(head, tail) that ``path`` matches exactly, and the (head, tail) of the keys that come before it:
    what matches one of those is counted there. The first digit is the scheme, the others the splits."""
    half = length // 2
    head, tail, earlier = (half, 0, []) if path[0] == "0" else (0, length - half, [(half, 0)])
    for digit in path[1:]:
        middle = length - head - tail
        more = (middle + 1) // 2
        if digit == "0":
            head += more
        else:
            earlier.append((head + more, tail))
            tail += middle - more
    return head, tail, earlier


def search_shard(table: pa.Table) -> pa.Table:
    """Per query of a shard (rows whose ``m`` is their word's length): near words and the best of them."""
    texts, counts, lengths, paths = (table.column(c).to_pylist() for c in ("word", "n", "m", "path"))
    known = {t.encode("latin-1"): n for t, n in zip(texts, counts)}
    vocabulary = sorted(known)
    n = np.array([known[w] for w in vocabulary], np.int64)
    back = sorted(range(len(vocabulary)), key=lambda i: vocabulary[i][::-1])
    forward, backward = Index(vocabulary), Index([vocabulary[i][::-1] for i in back])
    flat = np.frombuffer(b"".join(vocabulary) + b"\0", np.uint8)
    size = np.array([len(w) for w in vocabulary], np.int64)
    start = np.cumsum(size) - size
    back = np.array(back, np.int64)

    def alike(q: np.ndarray, found: np.ndarray, patterns: np.ndarray, head: int, tail: int) -> np.ndarray:
        """Whether a found word has the first ``head`` and the last ``tail`` symbols of its query."""
        fits = size[found] >= head + tail
        length, end = patterns.shape[1], start[found] + size[found]
        if length > LONG:
            for at in np.flatnonzero(fits).tolist():
                word, a, b = patterns[q[at]], start[found[at]], end[at]
                fits[at] = np.array_equal(flat[a:a + head], word[:head]) and np.array_equal(flat[b - tail:b], word[length - tail:])
            return fits
        for k in range(head):
            fits[fits] &= flat[start[found[fits]] + k] == patterns[q[fits], k]
        for k in range(1, tail + 1):
            fits[fits] &= flat[end[fits] - k] == patterns[q[fits], length - k]
        return fits

    batches: dict[tuple[int, str], list[bytes]] = {}
    for text, m, path in zip(texts, lengths, paths):
        if len(text) == m:
            batches.setdefault((m, path), []).append(text.encode("latin-1"))
    out: list[tuple] = []
    for (m, path), queries in batches.items():
        head, tail, earlier = parts(m, path)
        many = max(1, min(QUERIES, SYMBOLS * 8 // m))
        for at in range(0, len(queries), many):
            group = queries[at:at + many]
            patterns = np.frombuffer(b"".join(group), np.uint8).reshape(-1, m)
            if m > LONG:
                side = (forward, np.arange(len(n)), vocabulary, group, head, 1) if head >= tail else (backward, back, vocabulary, group, tail, -1)
                q, found = _compared(*side)
                fits = alike(q, found, patterns, head, tail)
                q, found = q[fits], found[fits]
            elif head >= tail:
                q, rank = _search(forward, backward, patterns, head, tail)
                found = back[rank]
            else:
                q, found = _search(backward, forward, patterns[:, ::-1], tail, head)
            for h, t in earlier:
                counted = alike(q, found, patterns, h, t)
                q, found = q[~counted], found[~counted]
            near = np.bincount(q, minlength=len(group))
            best = np.full(len(group), -1, np.int64)  # greatest n, then smallest word
            np.maximum.at(best, q, n[found] * (len(n) + 1) + len(n) - found)
            for w, k, b in zip(group, near.tolist(), best.tolist()):
                form = len(n) - b % (len(n) + 1) if b >= 0 else -1
                out.append((w.decode("latin-1"), known[w], k, *((vocabulary[form].decode("latin-1"), int(n[form])) if b >= 0 else (None, None))))
    columns = list(zip(*out)) or [()] * 5
    return pa.table({name: pa.array(list(c), kind) for (name, kind), c in zip(_FOUND, columns)})


_FOUND = (("word", pa.string()), ("n", pa.int64()), ("near", pa.int64()), ("best", pa.string()), ("best_n", pa.int64()))
_MIDDLE = "m - head - tail"  # code points that may hold the error


def _keyed(states: DataFrame) -> DataFrame:
    return states.where(F.length("word") >= F.col("head") + F.col("tail")).withColumn("key", F.xxhash64(
        "m", "head", "tail", F.expr("left(word, head)"), F.expr("right(word, tail)")))


def shards(spark: SparkSession, vocabulary: DataFrame, root: str, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, m, path, shard): every word under the keys of the queries that may be near it."""
    half = F.floor(F.col("m") / 2).cast("int")
    states = (vocabulary.select("word", "n", F.explode(F.expr(
                  "transform(array(-1, 0, 1), d -> cast(length(word) as int) + d)")).alias("m")).where("m > 0")
              .select("*", F.explode(F.array(F.lit("0"), F.lit("1"))).alias("path"))
              .select("*", F.when(F.col("path") == "0", half).otherwise(0).alias("head"),
                      F.when(F.col("path") == "1", F.col("m") - half).otherwise(0).alias("tail")))
    done, level = None, 0
    while True:
        states = stored(_keyed(states), f"{root}/keys-{level}")
        load = states.groupBy("key").agg(F.sum(F.length("word") + 1).alias("load"), F.count(F.lit(1)).alias("words"),
                                         F.max(F.expr(_MIDDLE)).alias("middle"))
        large = stored(load.where((F.col("load") > symbols) & (F.col("words") > FEW) & (F.col("middle") > 1)).select("key"),
                       f"{root}/large-{level}")
        if large.isEmpty():
            done = states if done is None else done.unionByName(states)
            break
        small = states.join(bounded(large), "key", "left_anti").select(*states.columns)
        done = small if done is None else done.unionByName(small)
        middle = F.expr(_MIDDLE)
        more = F.ceil(middle / 2).cast("int")
        split = states.join(bounded(large), "key", "left_semi").withColumns({"more": more, "rest": (middle - more).cast("int")})
        states = (split.select("word", "n", "m", "path", "head", "tail", "more", "rest",
                               F.explode(F.array(F.lit("0"), F.lit("1"))).alias("digit"))
                  .select("word", "n", "m", F.concat("path", "digit").alias("path"),
                          (F.col("head") + F.when(F.col("digit") == "0", F.col("more")).otherwise(0)).alias("head"),
                          (F.col("tail") + F.when(F.col("digit") == "1", F.col("rest")).otherwise(0)).alias("tail")))
        level += 1
    total = done.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    return done.select("word", "n", "m", "path", F.pmod("key", F.lit(max(1, -(-total // symbols)))).alias("shard"))


def near_words(spark: SparkSession, vocabulary: DataFrame, root: str, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, n_near, best, best_n): near words of every word and the one of largest n."""
    dealt = shards(spark, vocabulary, root, symbols)
    found = dealt.groupBy("shard").applyInArrow(search_shard, "word string, n long, near long, best string, best_n long")
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best"))).alias("first")
    return (found.groupBy("word", "n").agg(F.sum("near").alias("n_near"), best)
            .select("word", "n", "n_near", F.col("first.best").alias("best"), (-F.col("first.less")).alias("best_n")))


def variants(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = EVERY,
             min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = 2, symbols: int = SYMBOLS) -> DataFrame:
    """One row per word: word, n, n_near, form (the near word of largest n, if that is ``ratio`` times the
    word's n at least), form_n, root (the end of the chain of forms)."""
    if ratio < 2:
        raise ValueError("ratio below 2 would not make the chains of forms end")
    root = run_dir(spark, "spelling")
    vocabulary = stored(words(docs, id_col, text_col, every, min_chars, min_count), f"{root}/words")
    near = near_words(spark, vocabulary, root, symbols)
    taken = F.col("best_n") >= ratio * F.col("n")
    near = stored(near.select("word", "n", "n_near", F.when(taken, F.col("best")).alias("form"),
                              F.when(taken, F.col("best_n")).alias("form_n")), f"{root}/near")
    chain, level = near.where("form IS NOT NULL").select("word", F.col("form").alias("root")), 0
    while True:
        chain = stored(chain, f"{root}/chain-{level}")
        ahead = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if chain.join(ahead, "root", "left_semi").isEmpty():
            break
        chain = chain.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        level += 1
    return near.join(chain, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
