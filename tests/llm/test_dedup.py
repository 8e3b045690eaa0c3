import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from comms_lake.llm import exact_dedup, simhash

WHITE = re.compile(r"[\x20\x09-\x0D]")


def brute_groups(rows):
    groups = {}
    for at, (doc, text) in enumerate(rows):
        groups.setdefault(WHITE.sub("", text or ""), []).append((-len(text or ""), doc is None, doc or 0, at, doc))
    return {k: (min(v)[-1], len(v)) for k, v in groups.items()}


def cases():
    rng = random.Random(5)
    base = ["", " \t\n", None, "a b", "ab", "a b", "A b", "é è", "long " * 4000]
    rows = [(i, rng.choice(base)) for i in range(80)] + [(200, "ab"), (200, "ab"), (None, "only"), (None, "ab"), (7, "x")]
    return rows + [(1000 + i, "hot copy " + " " * (i % 3)) for i in range(700)]


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups_match_brute_force(spark, docs_of, weak):
    rows = cases()
    digest = (lambda n: F.unhex(F.substring(F.sha2(n, 256), 1, 2))) if weak else exact_dedup.sha256
    out = exact_dedup.exact_dedup(spark, docs_of(rows), digest=digest).collect()
    want = brute_groups(rows)
    assert len(out) == len(rows)
    got = sorted((r.id is None, r.id or 0, r.keep_id is None, r.keep_id or 0, r.size) for r in out)
    assert got == sorted((d is None, d or 0, (k := want[WHITE.sub("", t or "")])[0] is None, k[0] or 0, k[1]) for d, t in rows)
    assert sum(r.kept for r in out) == len(want)  # one row of each group, repeated rows included
    if not weak:
        assert {r.digest.hex() for r in out} == {hashlib.sha256(k.encode()).hexdigest() for k in want}


def test_keep_first_keeps_columns_and_clashing_names(spark, docs_of):
    docs = docs_of(cases()).withColumns({c: F.lit(1) for c in ("kept", "digest", "file", "at_file", "size")})
    out = exact_dedup.keep_first(spark, docs)
    assert out.columns == docs.columns and out.count() == len(brute_groups(cases()))


def test_empty_tables(spark, docs_of):
    empty = docs_of([(1, "x")]).where("doc_id > 5")
    assert exact_dedup.exact_dedup(spark, empty).isEmpty() and exact_dedup.keep_first(spark, empty).isEmpty()
    assert simhash.near_duplicates(spark, empty).isEmpty() and simhash.keep_one(spark, empty).isEmpty()


# --- SimHash -------------------------------------------------------------------------------------
def brute_print(text, shingle=3):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + shingle]).encode(), 42)
              for i in range(max(1, len(words) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits=2):
    values = sorted(set(prints))
    label = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= bits and label[a] < label[b]:
                    label[b] = label[a]
                    changed = True
    return label


def test_fingerprints_and_components_match_brute_force(spark, docs_of):
    rng = random.Random(9)
    words = ["Alpha", "beta", "Ümlaut", "d", "E5", "zeta", "eta", "theta"]
    texts = [None, "", " ", "One", "one two", "One Two three", "x" * 30000, "a b " * 5000]
    texts += [" ".join(rng.choices(words, k=rng.randint(3, 60))) for _ in range(60)]
    texts += [t + " tail" for t in texts[8:30]] + texts[8:20]
    rows = [(100 - i, t) for i, t in enumerate(texts)] + [(None, "One"), (3, "One"), (3, "One")]
    out = simhash.near_duplicates(spark, docs_of(rows)).collect()
    assert len(out) == len(rows)
    label = brute_components([brute_print(t) for _, t in rows])
    first = {}
    for d, t in rows:
        if d is not None:
            k = label[brute_print(t)]
            first[k] = min(first.get(k, d), d)
    want = sorted((d is None, d or 0, brute_print(t), first[label[brute_print(t)]]) for d, t in rows)
    assert sorted((r.id is None, r.id or 0, r.fp & (2**64 - 1), r.component) for r in out) == want
    kept = simhash.keep_one(spark, docs_of(rows)).collect()
    assert len(kept) == len(first) and sorted(r.doc_id for r in kept) == sorted(first.values())


@pytest.mark.parametrize("leaf_rows", [4, 64, 100_000])
def test_links_on_dense_clusters_are_exact(spark, leaf_rows):
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64)
    values = set(rng.integers(0, 2**63, 500, dtype=np.uint64).tolist())
    for c in centres:
        for _ in range(60):  # clusters in which chains of links matter
            v = int(c)
            for b in rng.choice(64, rng.integers(0, 6), replace=False):
                v ^= 1 << int(b)
            values.add(v)
    signed = [(v - 2**64 if v >> 63 else v,) for v in values]
    fps = spark.createDataFrame(signed, "fp long").repartition(3)
    links = [(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in simhash.links(spark, fps, 2, leaf_rows).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in links)
    label = brute_components(values)
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    assert {v: find(v) for v in values} == label


def test_components_of_a_long_chain_and_a_star(spark, tmp_path):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(200)]
    random.Random(2).shuffle(edges)
    out = simhash.components(spark, spark.createDataFrame(edges, "a long, b long"), str(tmp_path))
    got = {r.node: r.label for r in out.collect()}
    assert got == {i: 0 if i < 500 else 1000 for e in edges for i in e}


def test_components_of_links_that_differ_at_each_computation(spark, tmp_path):
    """Spanning links of the same groups, others each time they are computed: labels must still meet."""
    import pyarrow as pa

    def spanning(batches):
        import os
        rng = random.Random(os.urandom(8))
        for batch in batches:
            for group in batch.column(0).to_pylist():
                nodes = [group * 10 + k for k in range(8)]
                rng.shuffle(nodes)
                yield pa.RecordBatch.from_pydict({"a": nodes[1:], "b": [nodes[rng.randrange(k)] for k in range(1, 8)]})
    edges = spark.range(40).mapInArrow(spanning, "a long, b long")
    labels = simhash.components(spark, edges, str(tmp_path))
    assert {(r.node, r.label) for r in labels.collect()} == {(g * 10 + k, g * 10) for g in range(40) for k in range(8)}
