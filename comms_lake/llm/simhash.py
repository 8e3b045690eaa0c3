"""SimHash near-duplicates by distributed vantage-point trees (operator 8).

Each text gets a 64-bit fingerprint of its word shingles. Fingerprints link
at ``max_bits`` or fewer differing bits; a component is all that links reach.

The tree. Level l of the tree owns 8 of the 64 bits and a vantage point; a
node splits its fingerprints by Hamming distance to the vantage point over
the level's bits (nine rings). For two fingerprints within r bits the triangle
inequality bounds the difference of their ring numbers by the bits they differ
in on that level, and as levels own different bits these bounds add up: a
search that has crossed k rings on its way down has r - k left. So a search
visits few branches even at great depth, where a plain tree over all bits,
with the whole radius left at every level, would visit nearly all.

The job. Distinct fingerprints are counted by tree cell; cells with more than
``leaf_rows`` are split a level further (the driver gets those cells alone, at
most 65,536 a level, as ``leaf_rows`` grows with the number of fingerprints
beyond that). Every fingerprint goes to its own leaf, and as a query to the
leaves that its radius overlaps, to one of each two leaves only. A leaf
searches pairs exactly and reduces them to spanning links (at most one a
row). Components are then found by label propagation with pointer jumping,
each round a written table.

Vantage points are picked from a sample of ``SAMPLE`` fingerprints by the
spread of the sample's distances; they change the speed, never the result.

Defined cases: null text counts as empty; a text without words has
fingerprint zero, linked like any other; null identifiers never become a
component's identifier unless the component has no other (then it is null);
repeated rows share their component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import run_dir
from .common import drop_rows, located, map_texts, stored

SEED, BITS, LEVELS, WIDTH = 42, 64, 8, 8
SAMPLE = 2048  # fingerprints that vantage points are picked from
LEAF_ROWS, CELLS = 8192, 65_536  # a leaf is searched by descending further, in memory
BLOCK = 1 << 22  # pairs compared at once in a leaf
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = [0, *(ends[:n - shingle] + 1).tolist()]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())])
    ones = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` replaced by ``fp`` (the fingerprint as a signed long)."""
    def make():
        def run(texts: list) -> list[list]:
            return [[int(np.uint64(fingerprint(t, shingle)).astype(np.int64)) for t in texts]]
        return run
    return map_texts(docs, make, "fp long", text_col)


class Levels:
    """The bits and the vantage point of each level."""

    def __init__(self, sample: np.ndarray):
        rng = np.random.default_rng(SEED)
        order = rng.permutation(BITS).reshape(LEVELS, WIDTH)
        self.masks = [int(sum(1 << int(b) for b in bits)) for bits in order]
        if len(sample) == 0:
            sample = np.zeros(1, np.uint64)
        tries = rng.choice(sample, 32)
        self.points = []
        for mask in self.masks:
            spread = [np.bitwise_count((sample ^ t) & np.uint64(mask)).var() for t in tries]
            self.points.append(int(tries[int(np.argmax(spread))]) & mask)

    def ring(self, level: int, fps: np.ndarray) -> np.ndarray:
        return np.bitwise_count((fps & np.uint64(self.masks[level])) ^ np.uint64(self.points[level])).astype(np.int64)

    def cell(self, fp: Column) -> Column:
        """The path over all levels: a hexadecimal digit per level."""
        signed = lambda x: F.lit(x - (1 << 64) if x >> 63 else x).cast("long")
        path = F.lit(0).cast("long")
        for mask, point in zip(self.masks, self.points):
            ring = F.bit_count(fp.bitwiseAND(signed(mask)).bitwiseXOR(signed(point))).cast("long")
            path = F.shiftleft(path, 4).bitwiseOR(ring)
        return path


class Tree:
    """Which cells are split: per level the sorted paths of the inner nodes."""

    def __init__(self, levels: Levels, inner: list[np.ndarray]):
        self.levels, self.inner = levels, inner

    def route(self, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index, leaf, own): each fingerprint's own leaf, and the other leaves within
        ``radius`` whose code is greater (the other order is found from there)."""
        index, path, left = np.arange(len(fps)), np.zeros(len(fps), np.int64), np.full(len(fps), radius)
        out: list[tuple] = []
        for level in range(LEVELS + 1):
            if level < LEVELS and len(self.inner[level]):
                at = np.searchsorted(self.inner[level], path).clip(0, len(self.inner[level]) - 1)
                split = self.inner[level][at] == path
            else:
                split = np.zeros(len(path), bool)
            out.append((index[~split], path[~split] << 4 | level, left[~split] == radius))
            index, path, left = index[split], path[split], left[split]
            if not len(index):
                break
            ring = self.levels.ring(level, fps[index])
            parts = []
            for step in range(-radius, radius + 1):
                ok = (left >= abs(step)) & (ring + step >= 0) & (ring + step <= WIDTH)
                parts.append((index[ok], path[ok] << 4 | ring[ok] + step, left[ok] - abs(step)))
            index, path, left = (np.concatenate(x) for x in zip(*parts))
        index, leaf, own = (np.concatenate(x) for x in zip(*out))
        home = np.empty(len(fps), np.int64)
        home[index[own]] = leaf[own]
        keep = own | (leaf > home[index])
        return index[keep], leaf[keep], own[keep]


def plant(spark: SparkSession, fps: DataFrame, leaf_rows: int) -> Tree:
    """Count cells and split the large ones. The driver gets a bounded sample and the inner nodes only."""
    picked = fps.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toArrow().column("fp").to_numpy()
    levels = Levels(picked.astype(np.int64).view(np.uint64))
    leaf_rows = max(leaf_rows, -(-fps.count() // CELLS))
    cells = fps.groupBy(levels.cell(F.col("fp")).alias("path")).agg(F.count(F.lit(1)).alias("n"))
    nodes = (cells.select(F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("level"), "path", "n")
             .groupBy("level", F.expr(f"shiftright(path, 4 * ({LEVELS} - level))").alias("path"))
             .agg(F.sum("n").alias("n")).where(F.col("n") > leaf_rows).select("level", "path").toArrow())
    at, path = nodes.column("level").to_numpy(), nodes.column("path").to_numpy()
    return Tree(levels, [np.sort(path[at == level]).astype(np.int64) for level in range(LEVELS)])


def near(a: np.ndarray, b: np.ndarray, radius: int, levels: Levels, level: int) -> Iterator[tuple]:
    """Index pairs of ``a`` and ``b`` within ``radius`` bits: descend both sides of the
    tree together, over rings that differ by the radius left, down to blocks compared outright."""
    def walk(i: np.ndarray, j: np.ndarray, level: int, left: int) -> Iterator[tuple]:
        if len(i) * len(j) > BLOCK and level < LEVELS:
            ri, rj = levels.ring(level, a[i]), levels.ring(level, b[j])
            for x in np.unique(ri):
                for y in np.unique(rj[np.abs(rj - x) <= left]):
                    yield from walk(i[ri == x], j[rj == y], level + 1, left - abs(int(x - y)))
            return
        step = max(1, BLOCK // max(1, len(j)))
        for k in range(0, len(i), step):
            x, y = np.nonzero(np.bitwise_count(a[i[k:k + step], None] ^ b[None, j]) <= radius)
            yield i[k:k + step][x], j[y]

    if len(a) and len(b):
        yield from walk(np.arange(len(a)), np.arange(len(b)), level, radius)


def _spanning(n: int, pairs: Iterator[tuple]) -> list[tuple[int, int]]:
    """Links enough to connect what ``pairs`` connect: at most n - 1."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    out = []
    for left, right in pairs:
        for x, y in zip(left.tolist(), right.tolist()):
            p, q = find(x), find(y)
            if p != q:
                root[max(p, q)] = min(p, q)
                out.append((x, y))
    return out


def links(spark: SparkSession, fps: DataFrame, max_bits: int = 2, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints ``fp`` within ``max_bits`` of each other."""
    tree = plant(spark, fps, leaf_rows)
    shared = spark.sparkContext.broadcast(tree)  # inner nodes: at most 65,536 a level, 8 bytes each

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            index, leaf, own = shared.value.route(values.view(np.uint64), max_bits)
            for k in range(0, len(index), 1 << 17):
                cut = slice(k, k + (1 << 17))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf[cut]), pa.array(values[index[cut]]), pa.array(own[cut])], names=["leaf", "fp", "own"])

    def search(leaf: pa.Table) -> pa.Table:
        own = leaf.column("own").to_numpy()
        values = leaf.column("fp").to_numpy()
        home, guest = values[own], values[~own]
        depth = int(leaf.column("leaf")[0].as_py()) & 15
        both = np.concatenate([home, guest])
        points = both.view(np.uint64)
        n = len(home)

        def pairs():
            levels = shared.value.levels
            yield from near(points[:n], points[:n], max_bits, levels, depth)
            for x, y in near(points[:n], points[n:], max_bits, levels, depth):
                yield x, y + n
        found = np.array(_spanning(len(both), pairs()), np.int64).reshape(-1, 2)
        return pa.table({"a": both[found[:, 0]], "b": both[found[:, 1]]})

    return (fps.select("fp").mapInArrow(route, "leaf long, fp long, own boolean")
            .groupBy("leaf").applyInArrow(search, "a long, b long"))


def components(spark: SparkSession, edges: DataFrame, root: str) -> DataFrame:
    """(node, label): the smallest node that (a, b) links reach, for every linked node.

    Each round hands every node the smallest label next to it and then jumps
    to that label's label; rounds grow with the logarithm of the longest
    chain. Per-node minima are combined before the shuffle.
    """
    # stored first: computed for each direction apart, a leaf's rows may come in another order and give other
    # spanning links, and labels pass along links that go both ways only
    edges = stored(edges.select("a", "b"), f"{root}/links")
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, f"{root}/edges")
    labels = (both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
              .select("node", F.least("node", "least").alias("label"), F.lit(True).alias("changed")))
    number = 0
    while True:
        labels = stored(labels, f"{root}/labels-{number}")
        if labels.where("changed").isEmpty():
            return labels.select("node", "label")
        known = labels.select("node", F.col("label").alias("now"))
        # the smallest label of a node's neighbours, given to the node and to its label (hooking) ...
        offers = (both.join(known.withColumnRenamed("node", "b"), "b")
                  .groupBy(F.col("a").alias("node")).agg(F.min("now").alias("offer")))
        seen = known.join(offers, "node")
        hooked = (seen.select("node", "offer").union(seen.select("now", "offer")).union(seen.select("node", "now"))
                  .groupBy("node").agg(F.min("offer").alias("label")))
        hooked = stored(hooked, f"{root}/hooked-{number}")
        # ... and then the label of that label
        jumped = (hooked.join(hooked.select(F.col("node").alias("label"), F.col("label").alias("next")), "label", "left")
                  .select("node", F.least("label", "next").alias("label")))
        labels = (jumped.join(known, "node")
                  .select("node", "label", (F.col("label") != F.col("now")).alias("changed")))
        number += 1


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 2, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """One row per row of ``docs``: file, row, id, fp, component (its smallest
    identifier), keep_file and keep_row (the row with that identifier, first by file and row)."""
    docs, file, row = located(docs)
    root = run_dir(spark, "simhash")
    prints = fingerprints(docs.select(file.alias("file"), row.alias("row"), F.col(f"`{id_col}`").alias("id"),
                                      F.col(f"`{text_col}`").alias("text")), shingle)
    prints = stored(prints, f"{root}/prints")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "file", "row")).alias("first")
    fps = stored(prints.groupBy("fp").agg(first), f"{root}/fps")
    labels = components(spark, links(spark, fps, max_bits, leaf_rows), root)
    linked = stored(labels.withColumnRenamed("node", "fp").join(fps, "fp"), f"{root}/linked")
    least = stored(linked.groupBy("label").agg(F.min("first").alias("least")), f"{root}/least")
    known = linked.select("fp", "label").join(least, "label").select("fp", "least")
    component = stored(fps.join(known, "fp", "left").select("fp", F.coalesce("least", "first").alias("first")),
                       f"{root}/component")
    return prints.join(component, "fp").select(
        prints.file, prints.row, prints.id, "fp", F.col("first.id").alias("component"),
        F.col("first.file").alias("keep_file"), F.col("first.row").alias("keep_row"))


def keep_one(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each component (the smallest identifier), all columns."""
    docs, file, row = located(docs)
    out = near_duplicates(spark, docs, id_col, text_col, shingle, max_bits)
    gone = out.where((F.col("file") != F.col("keep_file")) | (F.col("row") != F.col("keep_row")))
    return drop_rows(docs, file, row, gone.select("file", "row"))
