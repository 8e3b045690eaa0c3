"""The registered queries over the given tables, and the pipeline against brute force."""
import hashlib
import zlib

import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from comms_lake.llm import bpe, langid, queries
from tests.llm.test_dedup import WHITE, brute_components, brute_print
from tests.llm.test_text_ops import brute_base, brute_contamination

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    read = lambda q: con.sql(q).fetchall()
    return {"documents": read(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet' ORDER BY doc_id"),
            "benchmark": read(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'"),
            "labels": dict(read(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'")),
            "pages": read(f"SELECT page_id, html FROM '{SF}/pages.parquet'")}


def rows_of(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def encoding():
    lines = open(public_tokenizers.path(bpe.MULTI_50K), "rb").read().splitlines()
    ranks = bpe.Codec(lines, public_tokenizers.PATTERN).ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_op1_and_op8(spark, tables):
    docs = tables["documents"]
    groups = {}
    for d, t, _ in docs:
        groups.setdefault(WHITE.sub("", t or ""), []).append((-len(t or ""), d))
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows_of(spark, "op1_exact_dedup")}
    want = {}
    for d, t, _ in docs:
        key = WHITE.sub("", t or "")
        keep = min(groups[key])[1]
        want[d] = (keep, len(groups[key]), keep == d, hashlib.sha256(key.encode()).hexdigest())
    assert got == want
    prints = {d: brute_print(t) for d, t, _ in docs}
    label = brute_components(prints.values())
    first = {}
    for d, f in prints.items():
        first[label[f]] = min(first.get(label[f], d), d)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows_of(spark, "op8_simhash")}
    assert got == {d: (f"{f:016x}", first[label[f]]) for d, f in prints.items()}


def test_op2_and_op7_held_out(spark, tables):
    got = {r.doc_id: r for r in rows_of(spark, "op2_quality")}
    assert set(got) == {d for d, *_ in tables["documents"]}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for d, r in got.items())
    held = [(got[d].predicted, q) for d, q in tables["labels"].items() if d in got and got[d].held_out]
    assert sum(p == q for p, q in held) / len(held) >= 0.8
    got = {r.doc_id: r for r in rows_of(spark, "op7_language")}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    held = [(got[d].lang_pred, lang) for d, _, lang in tables["documents"] if got[d].held_out and lang]
    assert sum(p == x for p, x in held) / len(held) > 0.9


def test_op3_to_op6(spark, tables):
    docs = tables["documents"]
    got = rows_of(spark, "op3_sharding")
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in got) == sorted(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, _ in docs)
    counts = {}
    for r in got:
        counts.setdefault(r.shard, []).append(r.slot)
    assert len(counts) == 40 and all(sorted(v) == list(range(len(v))) for v in counts.values())
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    want = brute_contamination([(d, t) for d, t, _ in docs], tables["benchmark"])
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows_of(spark, "op4_decontamination")}
    assert got == {d: (n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), c)
                   for (d, *_), (n, h, i, c) in zip(docs, want)}
    enc = encoding()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows_of(spark, "op5_bpe")}
    assert got == {d: (len(i := enc.encode_ordinary(t or "")), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
                       hashlib.sha256((t or "").encode()).hexdigest()) for d, t, _ in docs}
    got = {r.doc_id: r for r in rows_of(spark, "op6_pii")}
    for d, t, _ in docs:
        base = [f"{k}:{a}:{b}" for a, b, k in brute_base(t or "")]
        assert got[d].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(got[d].spans.split(","))


def test_op9_and_op10(spark, tables):
    named = {"CC-BY-NC": "Licensed under CC BY-NC 4.0.", "GPL": "GNU General Public License, version 3.",
             "Apache": "Apache License, Version 2.0.", "MIT": "MIT License."}
    got = {r.doc_id: r.families for r in rows_of(spark, "op9_licences")}
    assert got == {d: ",".join(sorted(f for f, line in named.items() if line in (t or ""))) for d, t, _ in tables["documents"]}
    assert len(rows_of(spark, "op10_html")) == len(tables["pages"])


def test_pipeline_matches_brute_force(spark, tables, docs_of):
    """Every stage on what the one before kept; planted copies and nulls included."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(10_001, tables["documents"][0][1]), (10_002, tables["documents"][1][1] + " \n"), (10_003, None), (10_004, "123"),
             (10_005, tables["benchmark"][0][1]), (10_001, tables["documents"][0][1])]
    docs = docs.unionByName(docs_of(extra)).withColumn("n_chars", F.col("n_chars").cast("long"))
    from comms_lake.session import materialize
    docs = materialize(docs, "pipeline-test")
    model = langid.learn(spark, queries.language_rows(docs))
    alive = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    step = docs
    expect = []
    rejected = model.predict([t for _, t in alive])[2]
    expect.append([x for x, bad in zip(alive, rejected) if not bad])
    best = {}
    for d, t in expect[-1]:
        key = WHITE.sub("", t)
        best[key] = min(best.get(key, (0, d, t)), (-len(t), d, t))
    expect.append([(d, t) for _, d, t in best.values()])
    prints = [(brute_print(t), d, t) for d, t in expect[-1]]
    label = brute_components([f for f, *_ in prints])
    first = {}
    for f, d, t in prints:
        first[label[f]] = min(first.get(label[f], (d, t)), (d, t))
    expect.append(list(first.values()))
    marks = brute_contamination(expect[-1], tables["benchmark"])
    expect.append([x for x, m in zip(expect[-1], marks) if not m[3]])
    assert len(rejected) > len(expect[0]) > len(expect[1]) and len(expect[3]) < len(expect[2])
    for (name, stage), want in zip(corpus_pipeline.STAGES[:-1], expect):
        step = materialize(stage(spark, step, SF), "stage")
        assert step.columns == docs.columns, name
        assert sorted((r.doc_id, r.text) for r in step.select("doc_id", "text").collect()) == sorted(want), name
    enc = encoding()
    out = corpus_pipeline.STAGES[-1][1](spark, step, SF).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in out) == sorted((d, len(enc.encode_ordinary(t))) for d, t in expect[-1])


def test_pipeline_stages_on_an_empty_table(spark, docs_of):
    empty = docs_of([(1, "a")]).where("doc_id > 5")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).isEmpty(), name


def test_pipeline_runs_over_documents(spark, tables):
    out = corpus_pipeline.run(spark, SF)
    assert set(out.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    n = out.count()
    assert 0 < n < len(tables["documents"]) and out.select("doc_id").distinct().count() == n
