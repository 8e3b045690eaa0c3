"""Lexical search, spelling variants and packing against brute force."""
import math
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from comms_lake.llm import lexical, packing, queries, spelling
from tests.llm.test_queries import SF, tables  # noqa: F401

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- ranked lexical search -----------------------------------------------------------------------
def brute_search(docs, items, top=20):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    bags = [(d, Counter(term.findall((t or "").translate(LOWER)))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    total, n_docs = sum(sum(b.values()) for _, b in bags), len(bags)
    df = Counter(w for _, b in bags for w in b)
    weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for w, k in df.items()}
    out = []
    for item, text in items:
        asked, scores = term.findall((text or "").translate(LOWER)), []
        for d, b in bags:
            m = 75 + 25 * sum(b.values()) * n_docs // total
            score = sum(weight[w] * (10**9 * b[w] // (1000 * b[w] + 12 * m)) for w in asked if w in b)
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:top], 1)]
    return Counter(out)


def got_search(df):
    return Counter((r.query_id, r["rank"], r.id, r.score) for r in df.collect())


def prose(rng, n, size=200):
    words = [f"w{k}" for k in range(size)] + ["Été", "x\x7fy", "ÀB"]
    return " ".join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=n))


def test_search_matches_brute_force(spark, docs_of):
    rng = random.Random(3)
    docs = [(k, prose(rng, rng.choice([3, 40, 400]))) for k in range(500)]
    docs += [(1000 + k, "same words here w3 w150") for k in range(90)]  # ties beyond the top
    docs += [(None, docs[0][1]), (7, docs[7][1]), (2000, None), (2001, ""), (2002, " .,- "), (2003, "w199 " * 30_000)]
    items = [(k, prose(rng, 12)) for k in range(25)] + [(30, "same w150"), (31, ""), (32, None), (None, "w5 w5 w7"), (30, "w1"),
                                                       (33, "nowhere"), (34, "ÉTÉ Été y")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumns({"score": F.lit(1), "query": F.lit(2)})
    clash = docs_of(docs).withColumns({c: F.lit(1) for c in ("id", "n", "at", "cell", "part", "rank")})
    want = brute_search(docs, items)
    for entries, query_bytes in ((lexical.ENTRIES, lexical.QUERY_BYTES), (700, 300)):  # many shards, several query blocks
        assert got_search(lexical.search(spark, clash, table, entries=entries, query_bytes=query_bytes)) == want


def test_blocks_are_skipped_only_by_exact_bounds(spark, monkeypatch):
    """Documents of two topics: few vectors are scored, and the result is that of scoring all."""
    import numpy as np
    import pyarrow as pa
    rng = random.Random(4)
    texts = [" ".join(rng.choices([f"{'ab'[k % 2]}{j}" for j in range(40)], k=30)) + (" rare" if k % 400 == 0 else "") for k in range(3000)]
    block = lexical.Queries(["rare a1 a1 a2", "b3 b4"], [0, 1])
    bags = [Counter(lexical.terms(t)) for t in texts]
    place = {w: k for k, w in enumerate(block.vocabulary)}
    mine = [sorted((place[w], c) for w, c in b.items() if w in place) for b in bags]
    block.weigh(len(bags), sum(map(len, mine)) * 5, np.array([sum(w in b for b in bags) for w in block.vocabulary]))
    rows = lexical.Rows(pa.table({"n": [30] * len(bags), "at": [[a for a, _ in m] for m in mine], "tf": [[c for _, c in m] for m in mine]}),
                        block.n_docs, block.total)
    scored = []
    plain = lexical.Rows.scores
    monkeypatch.setattr(lexical.Rows, "scores", lambda self, docs, w: scored.append(len(docs)) or plain(self, docs, w))
    shard = lexical.Shard(rows, block.weights)
    for _, at, value, dense in block.each():
        all_scores = plain(rows, np.arange(len(bags)), dense)
        best = np.lexsort((np.arange(len(bags)), -all_scores))[:5]
        scored.clear()
        docs, scores = shard.search(at, value, dense, 5, 1)
        assert docs.tolist() == best.tolist() and scores.tolist() == all_scores[best].tolist()
        assert sum(scored) < len(bags) / 2


def test_search_empty_tables(spark, docs_of):
    docs, none = docs_of([(1, "a b")]), docs_of([(1, "x")]).where("doc_id > 5")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(spark, none, items).isEmpty()
    assert lexical.search(spark, docs, items.where("item_id > 1")).isEmpty()
    assert got_search(lexical.search(spark, docs, items)) == brute_search([(1, "a b")], [(1, "a")])
    many = docs_of([(k, "a") for k in range(600)])
    assert lexical.search(spark, many, items).isEmpty()  # a term of so many documents, all, weighs nothing


# --- spelling variants ---------------------------------------------------------------------------
def brute_words(docs, every=97, min_chars=5, min_count=3):
    counts = Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}


def brute_variants(words, ratio=2):
    """Near words by deletion neighbourhoods: words that share a deleted form, checked."""
    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    forms = {}
    for w in words:
        for f in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            forms.setdefault(f, []).append(w)
    out = {}
    for w in words:
        other = {v for f in {w} | {w[:i] + w[i + 1:] for i in range(len(w))} for v in forms[f] if v != w and near(v, w)}
        best = min(other, key=lambda v: (-words[v], v), default=None)
        out[w] = (best if best and words[best] >= ratio * words[w] else None, len(other))
    rows = set()
    for w in words:
        root = w
        while out[root][0]:
            root = out[root][0]
        form, n_near = out[w]
        rows.add((w, form, root, words[w], n_near, words.get(form)))
    return rows


def got_variants(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def variant_docs():
    rng = random.Random(8)
    base = ["".join(rng.choices("abcéÿ", k=rng.randint(4, 9))) for _ in range(120)] + ["aaaaa", "aaaaaa", "aaaaaaa", "ab" * 200]
    docs = []
    for k in range(400):
        words = [rng.choice(base) for _ in range(30)]
        for j in range(0, 30, 3):
            w = words[j]
            i = rng.randrange(len(w))
            words[j] = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abé") + w[i:], w[:i] + rng.choice("abÉ") + w[i + 1:], w])
        docs.append((k, rng.choice([" ", "-", "Ā", "7"]).join(words).title()))
    return docs + [(None, docs[0][1]), (5, docs[5][1]), (900, None), (901, ""), (903, "kkkka " * 3 + "kkkkab " * 8 + "kkkkabé " * 20),
                   (902, ("zz" * 5000 + " ") * 3 + ("zz" * 5000 + "z ") * 9)]


@pytest.mark.parametrize("symbols", [spelling.SYMBOLS, 300])  # 300: keys are split again and again
def test_variants_match_brute_force(spark, docs_of, symbols):
    docs = variant_docs()
    clash = docs_of(docs).withColumns({c: F.lit(1) for c in ("word", "n", "m", "key", "shard")})
    words = brute_words(docs)
    want = brute_variants(words)
    assert len({w for w, form, *_ in want if form}) > 100 and any(f != r for _, f, r, *_ in want if f)
    assert got_variants(spelling.variants(spark, clash, symbols=symbols)) == want


def test_variants_of_short_words_and_empty_tables(spark, docs_of):
    rng = random.Random(2)
    docs = [(k, " ".join(rng.choices(["a", "b", "ab", "ba", "abc", "c", "é"], k=9))) for k in range(40)]
    want = brute_variants(brute_words(docs, min_chars=1, min_count=1))
    assert got_variants(spelling.variants(spark, docs_of(docs), min_chars=1, min_count=1)) == want
    assert spelling.variants(spark, docs_of(docs).where("doc_id < 0")).isEmpty()
    assert spelling.variants(spark, docs_of([(1, None), (2, "one of each")])).isEmpty()


# --- packing -------------------------------------------------------------------------------------
def encoder():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return made


def check_packed(rows, docs, with_ids, longest=2048):
    """Every id of every document in one piece; lengths are powers of two; sequence numbers are dense."""
    made = encoder()
    whole = [made.encode(t or "", add_special_tokens=False).ids + [1] for _, t in docs]
    want = Counter()
    for (d, _), ids in zip(docs, whole):
        at, left = 0, len(ids)
        while left:
            n = min(longest, 1 << (left.bit_length() - 1))
            part = ids[at:at + n]
            crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            want[(d, at, n, crc, len(ids), tuple(part) if with_ids else ())] += 1
            at, left = at + n, left - n
    assert Counter((r.id, r.start, r.length, r.ids_crc32, r.doc_tokens, tuple(r.ids) if with_ids else ()) for r in rows) == want
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows))) and all(r.offset == 0 for r in rows)
    order = [r.length for r in sorted(rows, key=lambda r: r.sequence_id)]
    assert order == sorted(order, reverse=True)  # buckets of equal length


def test_packing_matches_brute_force(spark, docs_of, tmp_path):
    rng = random.Random(6)
    docs = [(k, " ".join(rng.choices(["Word", "it's", "naïve", "\n\n", "日本", "<|endoftext|>", "12", "  x"], k=rng.randint(0, 900)))) for k in range(60)]
    docs += [(None, "no id"), (3, docs[3][1]), (70, None), (71, ""), (72, "a" * 200_000), (74, "x" + " " * 300_000 + "\n" * 3000 + "y"), (73, "some words and more " * 20_000)]
    clash = docs_of(docs).withColumns({c: F.lit(1) for c in ("start", "ids", "h", "range", "place", "length")})
    out = packing.pack(spark, clash, packing.Tokenizer(spark))
    check_packed(out.collect(), docs, True)
    packing.write_buckets(out, str(tmp_path / "buckets"))
    assert spark.read.parquet(str(tmp_path / "buckets")).where("length = 64").agg(F.min(F.size("ids"))).first()[0] == 64
    check_packed(packing.pack(spark, clash, packing.Tokenizer(spark), longest=64, with_ids=False).collect(), docs, False, 64)
    assert packing.pack(spark, clash.where("doc_id < 0"), packing.Tokenizer(spark)).isEmpty()


def test_stretches_keep_the_ids():
    rng = random.Random(9)
    text = "".join(rng.choices(["Word", " it's", " na", "ïve", "\n\n", " ", "  ", "日本", "12", " x", "'ll", "!"], k=40_000))
    cut = packing.stretches(text, 500)
    assert "".join(cut) == text and len(cut) > 20
    made = encoder()
    assert sum((made.encode(c, add_special_tokens=False).ids for c in cut), []) == made.encode(text, add_special_tokens=False).ids


def test_ranks_only_of_files_that_are_rank_tables():
    import json
    file = json.load(open(public_tokenizers.path("byte_bpe_50k.json")))
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read().splitlines()
    import base64
    assert packing.rank_table(file) == {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    file["model"]["merges"][:2] = file["model"]["merges"][1::-1]
    assert packing.rank_table(file) is None
    assert packing.rank_table(json.load(open(public_tokenizers.path("word_bpe_49k.json")))) is None


def test_registered_queries(spark, tables):  # noqa: F811
    docs = [(d, t) for d, t, _ in tables["documents"]]
    got = queries.op11_lexical(spark, SF)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == brute_search(docs, tables["benchmark"])
    assert got_variants(queries.op12_spelling(spark, SF)) == brute_variants(brute_words(docs))
    check_packed([r for r in queries.op13_packing(spark, SF).withColumnRenamed("doc_id", "id").collect()], docs, False)
