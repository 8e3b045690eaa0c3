"""Decontamination, personal data, quality, language, sharding, licences and HTML against brute force."""
import hashlib
import random
import re
import textwrap
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from comms_lake.llm import decontam, html_extract, langid, licences, pii, quality, sharding

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# --- decontamination -----------------------------------------------------------------------------
def brute_contamination(docs, items, window=13):
    out = []
    for _, text in docs:
        w = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for item, it in items:
            if item is None:
                continue
            v = WORD.findall((it or "").translate(LOWER))
            wins = [v[i:i + window] for i in range(max(1, len(v) - window + 1))] if v else []
            for win in wins:
                for i in range(len(w) - len(win) + 1):
                    if w[i:i + len(win)] == win:
                        hit.update(range(i, i + len(win)))
                        found.add(str(item))
        out.append((len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def contamination_cases():
    rng = random.Random(4)
    words = ["alpha", "Beta", "gámma", "d4", "e"]
    items = [(1, " ".join(rng.choices(words, k=20))), (2, "Just three words"), (10, None), (11, "!!"), (None, "ghost item"),
             (2, "second text of the same item"), (3, " ".join(rng.choices(words, k=13))), (4, "e e e e e")]
    docs = [(1, None), (2, ""), (3, "just THREE, words!"), (4, "just three word s"), (5, "x " * 500 + "just three words"),
            (6, items[0][1]), (7, "pre " + items[0][1].replace(" ", " - ") + " post"), (8, "e " * 40), (9, "ghost item"),
            (None, "second text of the same item"), (3, "just THREE, words!"), (12, "justthree words just\nthree\twords")]
    docs += [(100 + i, " ".join(rng.choices(words, k=rng.randint(1, 80)))) for i in range(40)]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 24, 1, 40])
def test_contamination_matches_brute_force(spark, docs_of, block_bytes):
    docs, items = contamination_cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    src = docs_of(docs).select("doc_id", "text").withColumns({"hits": F.lit(1), "found_items": F.lit(2)})
    out = decontam.contamination(spark, src, bench, block_bytes=block_bytes).collect()
    want = brute_contamination(docs, items)
    key = lambda r: (str(r[0]), r[1:])
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in out), key=key) == sorted(
        ((d, *w) for (d, _), w in zip(docs, want)), key=key)
    text = {d: t for d, t in docs}
    for r in out:  # offsets lead back to the original text
        if r.doc_id in (3, 7):
            a, b = map(int, r.spans[0].split(":"))
            assert text[r.doc_id][a:b].lower().startswith(("just three", items[0][1][:5].lower()))


def test_contamination_of_empty_tables_and_stage(spark, docs_of):
    docs, items = contamination_cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    src = docs_of(docs)
    assert decontam.contamination(spark, src.where("doc_id > 9999").select("text"), bench).isEmpty()
    none = decontam.contamination(spark, src.select("doc_id", "text"), bench.where("item_id > 99"))
    assert none.where("n_hit > 0 OR contaminated").isEmpty()
    kept = decontam.keep_clean(spark, src.withColumn("contaminated", F.lit("own")), bench)
    want = sum(not w[3] for w in brute_contamination(docs, items))
    assert kept.count() == want and kept.columns == [*src.columns, "contaminated"]


# --- personal data -------------------------------------------------------------------------------
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_base(text):
    digits = lambda s: re.sub(r"[^0-9]", "", s)

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
    out = [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), m.end(), "card") for m in CARD.finditer(text)
            if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aZ0149.@-+ ()_%é\n", max_size=60) | st.lists(st.sampled_from(
    ["4111 1111 1111 1111", "255", "0255", ".", "256", "+49 30 555 01 23", " ", "a@b.co", "@", "-", "1", "é"]), max_size=14).map("".join))
def test_base_spans_match_the_plain_patterns(text):
    assert pii.base(text) == brute_base(text)


FIELD = pii.Field()
FIELD.train([pii.labelled(r) for r in pii.LABELLED])


def brute_viterbi(field, scores):
    move = field.moves()
    first = np.zeros(pii.LABELS)
    first[2::2] = -1e9
    best = [(scores[0] + first, None)]
    for s in scores[1:]:
        ways = best[-1][0][:, None] + move
        best.append((ways.max(axis=0) + s, ways.argmax(axis=0)))
    label = [int(best[-1][0].argmax())]
    for _, back in reversed(best[1:]):
        label.append(int(back[label[-1]]))
    return label[::-1]


def test_viterbi_batches_match_one_by_one():
    rows = [pii.labelled(r)[0] for r in pii.LABELLED]
    lengths = np.array([len(r) for r in rows])
    no = np.zeros(len(rows), bool)
    got = FIELD.viterbi(np.concatenate(rows), lengths, no, no)
    want = [x for r in rows for x in brute_viterbi(FIELD, FIELD.scores(r))]
    assert got.tolist() == want


def test_training_is_the_gradient_of_the_likelihood():
    """The likelihood rises with training, and held-out lines are labelled right."""
    rows = [pii.labelled(r) for r in pii.LABELLED]
    field = pii.Field()
    field.train([r for k, r in enumerate(rows) if k % 6])
    held = [r for k, r in enumerate(rows) if k % 6 == 0]
    right = sum(int((np.array(brute_viterbi(field, field.scores(f))) == y).sum()) for f, y in held)
    assert right / sum(len(y) for _, y in held) > 0.9


def test_added_spans(spark, docs_of):
    text = "Call 415-555-2671 or (212) 555-0147.\nIn 2019, 1,200 people paid 3,400.50.\nmail a@b.co now"
    got = [text[a:b] for a, b, k in pii.added(FIELD, [text], [pii.base(text)])[0]]
    assert got == ["415-555-2671", "(212) 555-0147"]
    rows = [(1, text), (2, None), (3, ""), (4, "é" * 50_000 + " a@b.co"), (None, "1.2.3.4"), (1, text), (5, "\n\n12\n")]
    field = pii.model(spark)
    out = pii.spans(docs_of(rows).select("doc_id", "text").withColumn("spans_", F.lit(0)), field).collect()
    assert len(out) == len(rows)
    for r in out:
        t = dict(rows)[r.doc_id] or ""
        assert r["base"] == [f"{k}:{a}:{b}" for a, b, k in brute_base(t)]
        assert set(r["base"]) <= set(r["spans"])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in r["base"]) for k in pii.KINDS]
    assert pii.spans(docs_of(rows).where("doc_id > 99").select("doc_id", "text"), field).isEmpty()
    blank = pii.learn(spark.createDataFrame([], "row string"))
    assert pii.added(blank, [text], [[]]) == [[]]


# --- quality -------------------------------------------------------------------------------------
def prose(rng, n):
    return " ".join(rng.choice(["the", "river", "runs", "past", "old", "mill", "and", "under", "stone"]) for _ in range(n)) + "."


def quality_rows():
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(300):
        good = i % 3 > 0
        bad = rng.choice([lambda: " | ".join(prose(rng, 1) for _ in range(20)), lambda: (prose(rng, 1) + " ") * 40,
                          lambda: prose(rng, 30).upper().replace(" ", "!! ")])
        rows.append((i, prose(rng, rng.randint(5, 60)) if good else bad()))
        labels.append((i, int(good)))
    return rows, labels


def test_quality_buckets_of_many_words_at_once():
    words = ["a", "the", "año", "ß", "日本語", "x" * 64, "e\u0301", "\ud800", "😀ok", "<>", "0"]
    buckets, sizes = quality.words_buckets(words)
    assert np.split(buckets, np.cumsum(sizes)[:-1])[3].tolist() == list(quality.word_buckets("ß"))
    assert buckets.tolist() == [b for w in words for b in quality.word_buckets(w)]
    assert sizes.tolist() == [len(list(quality.word_buckets(w))) for w in words]


def test_quality_held_out_accuracy_and_cases(spark, docs_of):
    rows, labels = quality_rows()
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    docs = docs_of(rows + [(1000, None), (1001, ""), (1002, "word " * 60_000), (None, "the river"), (3, rows[3][1])])
    table = spark.createDataFrame([*labels, (None, 1), (5000, 1), (7, None)], "doc_id long, quality int")
    model = quality.learn(spark, docs, table.where(~F.col("doc_id").isin(held)))
    out = quality.score(spark, docs.select("doc_id", "text").withColumn("score_", F.lit(1)), model).collect()
    assert len(out) == len(rows) + 5 and all(0 <= r.score <= 1 for r in out)
    score = {r.doc_id: r.score for r in out}
    truth = dict(labels)
    right = [(score[i] >= 0.3) == truth[i] for i in held]
    assert sum(right) / len(right) > 0.95
    assert score[1000] == score[1001] and len({r.score for r in out if r.doc_id == 3}) == 1
    again = quality.learn(spark, docs.repartition(5), table.where(~F.col("doc_id").isin(held)))
    assert np.array_equal(again.weight, model.weight)  # the sample does not depend on the files
    blank = quality.learn(spark, docs, table.where("doc_id > 9999"))
    assert {r.score for r in quality.score(spark, docs.select("doc_id", "text"), blank).collect()} == {0.5}


def test_document_score_is_the_average_of_its_features():
    rows, _ = quality_rows()
    model = quality.Model(np.random.default_rng(0).normal(size=quality.BUCKETS))
    texts = [t for _, t in rows[:40]] + [None, "", "é é é", "x" * 100_000]
    for text, got in zip(texts, model.scorer()(texts)[0]):
        bucket, count = quality.document_counts(text)
        want = 1 / (1 + np.exp(-float((model.weight[bucket].astype(float) * count).sum() / count.sum())))
        assert got == pytest.approx(want, abs=1e-4)


# --- language ------------------------------------------------------------------------------------
SAMPLES = {"en": "the of and to in that is was for it with as his on be at by had not are but from or have an they which",
           "de": "der die und das von den mit sich für des ist im dem nicht ein eine als auch es an werden aus er hat",
           "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec"}


def brute_counts(text):
    data = (" " + langid._OTHER.sub(" ", text.lower()) + " ").encode()
    out = np.zeros(langid.DIMENSIONS, np.int64)
    for n in range(1, 5):
        for i in range(len(data) - n + 1):
            code = 0
            for b in data[i:i + n]:
                code = (code * 257 + b) % 2**32
            out[((code + n) * 2654435761 % 2**32) >> 19] += 1
    return out


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=40))
def test_ngram_counts(text):
    assert np.array_equal(langid.counts(text), brute_counts(text))


def test_long_texts_are_counted_whole(monkeypatch):
    text = "abc déf " * 300_000
    whole = langid.counts(text)
    assert whole.sum() > 4 * len(text)
    short = langid.counts("abc déf " * 1000)
    assert np.array_equal(whole > 0, short > 0)


def test_language_accuracy_rejection_and_cases(spark, docs_of):
    rng = random.Random(3)
    rows = []
    for i in range(240):
        lang = ["en", "de", "fr"][i % 3]
        rows.append((i, " ".join(rng.choices(SAMPLES[lang].split(), k=rng.randint(3, 80))), lang if i % 10 else None))
    odd = [(900, None, "en"), (901, "", "de"), (902, "123 !!", None), (903, "Съешь ещё этих мягких французских булок да выпей чаю " * 20, None),
           (904, "的一是不了人我在有他这为之大来以个中上们" * 30, None), (None, rows[0][1], "en"), (0, *rows[0][1:])]
    docs = docs_of(rows + odd)
    model = langid.learn(spark, docs.where("doc_id < 200 OR doc_id IS NULL"))
    assert model.names == ["de", "en", "fr"]
    out = langid.identify(spark, docs.select("doc_id", "text").withColumn("lang_pred_", F.lit(1)), model).collect()
    got = {r.doc_id: r for r in out}
    test = [(i, ["en", "de", "fr"][i % 3]) for i in range(200, 240)]
    assert sum(got[i].lang_pred == lang for i, lang in test) / len(test) > 0.95
    assert not any(got[i].rejected for i in range(240))
    for i in (900, 901, 902):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[903].rejected and got[904].rejected and got[903].lang_pred in model.names
    kept = langid.keep_known(spark, docs.withColumn("rejected", F.lit(1)), model)
    assert kept.count() == len(rows) + 2 and kept.columns == [*docs.columns, "rejected"]
    none = langid.learn(spark, docs.where("lang = 'xx'"))
    assert {r.lang_pred for r in langid.identify(spark, docs.select("text"), none).collect()} == {"und"}
    assert langid.keep_known(spark, docs.where("doc_id > 9999"), model).isEmpty()


def test_language_of_many_copies_is_learned(spark, docs_of):
    rng = random.Random(5)
    make = lambda lang: " ".join(rng.choices(SAMPLES[lang].split(), k=rng.randint(5, 60)))
    rows = [(i, make("de"), "de") for i in range(60)] + [(1000 + i, make("fr"), "fr") for i in range(60)]
    docs = docs_of(rows).unionByName(spark.range(60_000).select(  # 99.9 % copies, nulls and texts without letters
        (F.col("id") + 5000).alias("doc_id"), F.expr("CASE id % 3 WHEN 0 THEN 'das ist es' WHEN 1 THEN NULL ELSE '123' END").alias("text"),
        F.lit("de").alias("lang"), F.lit("src0").alias("source"), F.lit(9).cast("long").alias("n_chars")))
    model = langid.learn(spark, docs, sample_rows=20)
    assert model.names == ["de", "fr"]
    assert model.predict([make("de") for _ in range(30)])[0].count("de") >= 28


REAL = {
    "en": "the old man walked slowly through the forest while the sun went down behind the trees and he thought about his "
          "youth and about the house where he had grown up with his brothers and sisters who used to sit by the fire and "
          "tell each other stories about ships that never came back from the sea and about people who lived on the islands "
          "where it was always summer and nobody had to work for more than a few hours each day before they could rest",
    "de": "der alte mann ging langsam durch den wald während die sonne hinter den bäumen unterging und er dachte an seine "
          "jugend und an das haus in dem er mit seinen brüdern und schwestern aufgewachsen war die am feuer saßen und sich "
          "geschichten von schiffen erzählten die nie vom meer zurückkamen und von menschen die auf den inseln lebten wo es "
          "immer sommer war und niemand mehr als ein paar stunden am tag arbeiten musste bevor er sich ausruhen konnte"}
UNKNOWN = [
    "il sole era ormai tramontato quando il vecchio pescatore tornò al porto con la sua barca carica di pesce fresco e tutti "
    "gli abitanti del paese scesero sulla spiaggia per aiutarlo a scaricare le reti perché quella notte si annunciava una",
    "vanha kalastaja palasi satamaan myöhään illalla kun aurinko oli jo laskenut ja kaikki kylän asukkaat tulivat rannalle "
    "auttamaan häntä verkkojen purkamisessa koska sinä yönä oli luvattu kovaa myrskyä mereltä",
    "yaşlı balıkçı güneş battıktan sonra limana döndü ve köyün bütün sakinleri ağları boşaltmasına yardım etmek için sahile "
    "indiler çünkü o gece denizden büyük bir fırtına bekleniyordu ve acele etmek gerekiyordu"]


def test_repeated_lines_are_kept_and_unknown_latin_languages_rejected(spark, docs_of):
    rng = random.Random(11)
    line = lambda lang, n: " ".join(rng.choices(REAL[lang].split(), k=n))
    rows = []
    for i in range(200):  # prose of all lengths; one poor text a language must not loosen the floor
        lang = ["en", "de"][i % 2]
        rows.append((i, UNKNOWN[0] if i < 2 else line(lang, rng.choice([8, 20, 80, 300, 1500])), lang))
    model = langid.learn(spark, docs_of(rows))
    for lang in REAL:
        lines = [line(lang, n) for n in (9, 12, 16, 24) for _ in range(10)]
        for texts in (lines, [(t + "\n") * 100 for t in lines]):
            names, _, rejected = model.predict(texts)
            assert names == [lang] * len(texts) and not any(rejected)
    assert all(model.predict([x for t in UNKNOWN[1:] for x in (t, t[:100], (t + "\n") * 100)])[2])


def test_every_label_is_learned(spark, docs_of):
    words = {f"l{k:02}": ["".join(random.Random(k * 50 + j).choices("abcdefghijklmnopqrstuvwxyz", k=7)) for j in range(12)]
             for k in range(70)}
    make = lambda lang, seed: " ".join(random.Random(seed).choices(words[lang], k=25))
    rows = [(i, make(lang, i), lang) for i, lang in enumerate(lang for lang in words for _ in range(6 if lang > "l05" else 3))]
    model = langid.learn(spark, docs_of(rows))
    assert model.names == sorted(words)  # more than 64, the rarest too
    names, _, rejected = model.predict([make(lang, 10_000 + i) for i, lang in enumerate(words)])
    assert names == list(words) and not any(rejected)


# --- sharding ------------------------------------------------------------------------------------
def shard_rows():
    rng = random.Random(8)
    rows = [(i, "t" * rng.randint(0, 50), "en", "hot" if rng.random() < 0.6 else f"s{rng.randint(0, 4)}") for i in range(1003)]
    return rows + [(None, None, None, None), (None, "x", "en", ""), (5, "dup", "en", "s1"), (5, "dup", "en", "s1"), (6, "é", "en", None)]


@pytest.mark.parametrize("buckets", [4096, 8])
def test_shards_are_even_mixed_and_independent_of_files(spark, docs_of, buckets):
    rows = shard_rows()
    docs = docs_of(rows)
    out = sharding.shard(spark, docs, shards=40, buckets=buckets).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r)
        assert r.text_crc32 == zlib.crc32((dict((x[0], x[1]) for x in rows).get(r.id) or "").encode()) or r.id in (5, 6, None)
    assert set(by) == set(range(40))
    sizes = [len(v) for v in by.values()]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    total = sum(r[3] == "hot" for r in rows) / len(rows)
    for v in by.values():  # each shard has the mixture, to within a row a source
        assert abs(sum(r.source == "hot" for r in v) - total * len(v)) <= 2
    again = sharding.shard(spark, docs.repartition(7), shards=40, buckets=buckets).collect()
    key = lambda rs: sorted((str(r.id), r.size, r.shard, r.slot) for r in rs)
    assert key(again) == key(out)


def test_shards_match_a_direct_ranking(spark, docs_of):
    rows = [(i, str(i), "en", f"s{i % 3}" if i % 7 else "rare") for i in range(200)]
    docs = docs_of(rows)
    h = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64(
        F.lit(sharding.SEED), "doc_id", F.crc32(F.col("text").cast("binary")), (F.octet_length("text") + 16).cast("long")).alias("h")).collect()}
    turn = {r.source: r.t for r in docs.select("source", F.xxhash64(F.lit(sharding.SEED), "source", F.lit(False)).alias("t")).distinct().collect()}
    order = []
    for s in {r[3] for r in rows}:
        own = sorted((r for r in rows if r[3] == s), key=lambda r: (h[r[0]] % 4096, h[r[0]], r[0]))
        order += [((2 * k + 1) / (2 * len(own)), turn[s], s, h[r[0]], r[0]) for k, r in enumerate(own)]
    want = {doc: at * 40 // len(rows) for at, (*_, doc) in enumerate(sorted(order))}
    assert {r.id: r.shard for r in sharding.shard(spark, docs).collect()} == want


def test_sharding_few_rows_and_none(spark, docs_of):
    few = sharding.shard(spark, docs_of([(1, "a"), (2, "b"), (3, None)])).collect()
    assert len({r.shard for r in few}) == 3 and all(r.slot == 0 for r in few)
    assert sharding.shard(spark, docs_of([(1, "a")]).where("doc_id > 5")).isEmpty()


# --- licences ------------------------------------------------------------------------------------
MODEL = licences.Model(licences.NOTICES, licences.ORDINARY)


def test_grams_match_the_scan(spark):
    texts = ["Licensed under CC BY-NC 4.0.", "a", "", "The  GNU—General Public License, v. 2.0!", "x_y z...w -q- 1.2.3.", "É Ü ñ a b", "a b a b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", licences.gram_column(F.col("t")).alias("g")).collect():
        assert {g for g in r.g if g is not None} == licences.grams(r.t), r.t


def brute_scan(model, text):
    found, unconfirmed, scores = [], 0, []
    for line, p in enumerate((text or "").split("\n") if text is not None else []):
        own = licences.grams(p) & set(model.names)
        if not own:
            continue
        prob = model._softmax(model.logits(own) / model.temperature)
        k = int(prob[:-1].argmax())
        share = max([len(own & n) / len(n) for f, t in model.notices if f == model.families[k]
                     and (n := licences.grams(t) & set(model.names))], default=0)
        sure = prob[k] >= model.threshold
        if not sure and prob[-1] >= 0.5:
            continue
        scores.append(prob[k])
        if sure and share >= licences.CONFIRM:
            found.append((line, model.families[k]))
        else:
            unconfirmed += 1
    return sorted({f for _, f in found}), [f"{a}:{f}" for a, f in found], unconfirmed, max(scores, default=0.0)


def test_scan_matches_brute_force_and_cases(spark, docs_of):
    notices = [t for _, t in licences.NOTICES]
    rows = [(i, f"Some prose here.\n{t}\nMore prose.") for i, t in enumerate(notices)]
    rows += [(100, "Released under the MIT License.\nLicensed under CC BY 4.0."), (101, None), (102, ""), (103, "\n\n"),
             (104, "word " * 40_000 + "licensed under the Apache License, Version 2.0."), (None, notices[0]), (0, rows[0][1]),
             (105, "All rights reserved."), (106, "under the terms of some other license, version nine"), (107, notices[3][:60])]
    rows += [(200 + i, t) for i, t in enumerate(licences.ORDINARY)]
    out = licences.scan(spark, docs_of(rows).withColumns({"families": F.lit(1), "line": F.lit(2)}), MODEL).collect()
    assert len(out) == len(rows)
    key = lambda r: (str(r[0]), r[1:4])
    got = sorted(((r.id, r.families, r.lines, r.n_unconfirmed, r.score) for r in out), key=key)
    want = sorted(((d, *brute_scan(MODEL, t)) for d, t in rows), key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert all(g[4] == pytest.approx(w[4], abs=1e-6) for g, w in zip(got, want))
    named = {r.id: r.families for r in out}
    right = sum(named[i] == [f] for i, (f, _) in enumerate(licences.NOTICES) if i)
    assert right >= len(licences.NOTICES) - 2 and not any(named[200 + i] for i in range(len(licences.ORDINARY)))
    assert licences.scan(spark, docs_of(rows).where("doc_id > 9999"), MODEL).isEmpty()


def test_other_wordings_and_learning_from_the_corpus(spark, docs_of):
    docs = docs_of([(i, f"Line {i} of the book and of the house under the hill") for i in range(60)]
                   + [(99, "This work is licensed under the GNU General Public License, version 3."), (98, None)])
    model = licences.learn(spark, docs)
    out = {r.id: r.families for r in licences.scan(spark, docs, model).collect()}
    assert out[99] == ["GPL"] and all(not v for k, v in out.items() if k != 99)
    held = {"licensed under the MIT License, see below": "MIT", "Licensed under the Apache License 2.0": "Apache",
            "distributed under CC BY-NC 4.0.": "CC-BY-NC", "the GNU General Public License, version 3": "GPL"}
    found = {t: max(range(len(model.families) - 1), key=lambda k, t=t: model.logits(licences.grams(t))[k]) for t in held}
    assert {t: model.families[k] for t, k in found.items()} == held


def test_wrapped_and_dual_licences(spark, docs_of):
    wrapped = [(f, textwrap.fill(t, width)) for f, t in licences.NOTICES for width in (36, 70, 76, 80) if len(t) > 100]
    rows = [(i, "Some prose here.\n\n" + t.replace("\n", "\n# ") + "\n\nMore prose.") for i, (_, t) in enumerate(wrapped)]
    both = {500: "Licensed under the MIT license or the Apache License, Version 2.0.",
            501: "Released under the MIT License. Licensed under CC BY-SA 4.0."}
    prose = "\n".join(licences.ORDINARY * 3)
    out = {r.id: r for r in licences.scan(spark, docs_of(rows + list(both.items()) + [(600, prose)]), MODEL).collect()}
    for i, (family, text) in enumerate(wrapped):
        assert (out[i].families, out[i].n_confirmed, out[i].n_unconfirmed) == ([family], 1, 0), text
    assert out[500].families == ["Apache", "MIT"] and out[500].lines == ["0:Apache", "0:MIT"]
    assert out[501].families == ["CC-BY-SA", "MIT"]
    assert out[600].families == []


# --- HTML ----------------------------------------------------------------------------------------
LONG = ("It was the best of times and it was the worst of times, and all of us were there when it had to be done with the "
        "old house by the river that my father had built for us in the years before the war came to the town.")
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><p>{LONG}</p>";</script></head>
<body class="home"><header id="top"><h1>Site</h1></header><nav><ul><li><a href="/a">The one</a></li></ul></nav>
<div id="cookie-notice"><p>{LONG}</p></div><!-- {LONG} -->
<main><article class="post comments-open"><header><h1>My&nbsp;title &amp; more</h1></header><p>{LONG}</p><p>Short.</p>
<div class="ad">Buy it now</div><h2>Sub</h2><p>1 &lt; 2 and<br>a<b>old</b>
 text</p><form><p>{LONG}</p></form><aside>{LONG}</aside><p><i>Unclosed</p><ul><li>One</li><li>Two</li></ul></article>
<section id="comments"><p>{LONG}</p></section></main><footer>&copy; Site</footer></body></html>"""


def test_article_of_a_marked_page():
    assert html_extract.extract(PAGE) == "\n".join(
        ["My title & more", LONG, "Short.", "Sub", "1 < 2 and aold text", "Unclosed", "One", "Two"])


def test_unmarked_page_uses_the_neighbours():
    page = (f"<div><a href=x>Home</a> <a href=y>About</a></div><h1>Title</h1><p>{LONG}</p><p>Short one.</p><p>{LONG}</p>"
            "<p>See also</p><ul><li><a href=a>one thing</a></li><li><a href=b>another</a></li></ul><div>All rights</div>")
    assert html_extract.extract(page) == "\n".join(["Title", LONG, "Short one.", LONG])


NAV = "<div><a href=x>Home</a> <a href=y>About</a></div>"
LINKED = "<ul><li><a href=a>one thing</a></li><li><a href=b>another</a></li></ul><div>2024</div>"
FOREIGN = [
    "Stary rybak wrócił do portu późnym wieczorem, kiedy słońce już zaszło, a wszyscy mieszkańcy wioski zeszli na plażę, żeby "
    "pomóc mu rozładować sieci, ponieważ tej nocy zapowiadano wielką burzę nad morzem i trzeba było się spieszyć.",
    "Старый рыбак вернулся в порт поздно вечером, когда солнце уже зашло, и все жители деревни вышли на берег, чтобы помочь ему "
    "разгрузить сети, потому что этой ночью обещали сильную бурю с моря и надо было торопиться.",
    "Yaşlı balıkçı güneş battıktan sonra limana döndü ve köyün bütün sakinleri ağları boşaltmasına yardım etmek için sahile indiler, "
    "çünkü o gece denizden büyük bir fırtına bekleniyordu ve acele etmek gerekiyordu.",
    "老渔夫在太阳落山以后很晚才回到港口，村里所有的居民都来到海滩上帮助他卸下渔网，因为那天夜里预报海上会有很大的暴风雨，"
    "大家必须赶快把船拖到岸上，然后回家关好门窗，等待风雨过去，第二天早上再去看看海边的情况怎么样了，孩子们都睡不着觉。"]


@pytest.mark.parametrize("prose", FOREIGN)
def test_unmarked_page_in_a_language_without_listed_words(prose):
    page = f"{NAV}<h1>{prose[:19]}</h1><p>{prose}</p><p>{prose[:28]}</p><p>{prose}</p>{LINKED}"
    assert html_extract.extract(page) == "\n".join([prose[:19].strip(), prose, prose[:28].strip(), prose])
    assert html_extract.extract(f"<article><p>{prose}</p>{LINKED}<p>{prose}</p></article>").count(prose) == 2


def test_unmarked_page_keeps_code_tables_and_short_blocks_with_a_link():
    code = "for (int i = 0; i < rows.length; i++) { total += rows[i].value * factor(rows[i].kind); print(total); }".replace("<", "&lt;")
    names = "Anderson, Baker, Carter, Dawson, Ellis, Foster, Grant, Hughes, Irving, Jackson, Keller, Lambert"
    short = '<p>See <a href=z>this page</a> for more of it.</p>'
    page = f"{NAV}<p>{LONG}</p><pre>{code}</pre><p>{names}</p>{short}<p>{LONG}</p>{LINKED}"
    assert html_extract.extract(page) == "\n".join([LONG, code.replace("&lt;", "<"), names, "See this page for more of it.", LONG])


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain", ""), ("<p", ""), ("<article><p>a &am", "a &am"), ("<article>a <3 b</article>", "a <3 b"),
    ("<article><p>one<p>two<scr", "one\ntwo"), ("<article>x<script>never closed <p>y", "x"), ("<article>x<!-- y", "x"),
    ("<ARTICLE><P CLASS=AD>x</P><P>y", "y"), ("<article><p hidden>x<p>y</article>", "y"), ("</div></p><article>ok", "ok"),
    ("<article><div hidden>no</div>yes</article>", "yes"), ("<article>&#65;&#x42;&copy;&notanentity;", "AB©¬anentity;"),
    ("<article><textarea><p>no</textarea>yes<svg><text>no</text></svg>", "yes")])
def test_odd_pages(html, text):
    assert html_extract.extract(html) == text


def test_long_and_hostile_pages_take_linear_time():
    for page in ("<div>" * 40_000 + "</nav>" * 40_000, "<a '" * 50_000, "<" * 100_000, "<!--" * 50_000, "<p>x" * 50_000):
        html_extract.extract(page)
    assert html_extract.extract("<article>" + f"<p>{LONG}</p>" * 3000).count("\n") == 2999


def test_pages_query(spark):
    rows = [(1, "u", PAGE), (2, None, None), (None, "v", ""), (1, "u", PAGE)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = html_extract.extract_pages(pages).collect()
    assert len(out) == 4 and all(r.n_chars == len(r.text) for r in out)
    assert sum(r.text == html_extract.extract(PAGE) for r in out) == 2
    assert html_extract.extract_pages(pages.where("page_id > 5")).isEmpty()


def test_the_field_adds_variants_that_the_patterns_miss(spark, docs_of):
    """None of these spans is in the labelled table; the base patterns find none of them."""
    want = {"please call 020 7946 0871 now": "phone:020 7946 0871", "ring 555-0149 please": "phone:555-0149",
            "the host 192 . 0 . 2 . 44 is up": "ip:192 . 0 . 2 . 44", "block 198.51.100[.]77 now": "ip:198.51.100[.]77",
            "write to eve.ray [at] mail.example.net today": "email:eve.ray [at] mail.example.net",
            "mail joe at host dot net for details": "email:joe at host dot net",
            "ask lee (at) mail (dot) example (dot) com": "email:lee (at) mail (dot) example (dot) com",
            "see 2001:db8:85a3::8a2e:370:7334 there": "ip:2001:db8:85a3::8a2e:370:7334",
            "card 5105.1051.0510.5100 was used": "card:5105.1051.0510.5100",
            "in 2019, 45 people bought 1,250 items at noon": None, "pages 14-19 and 31-42": None, "version 1.4.3 at section 3.6": None,
            "we looked at the dot on www.example.com at 10:45": None, "the total of 310 000 and 420 000": None}
    texts = list(want)
    assert not any(pii.base(t) for t in texts)
    from comms_lake.llm import queries  # the thin query's model
    out = pii.spans(docs_of(list(enumerate(texts))), pii.model(spark)).collect()
    got = {}
    for r in out:
        text = texts[r.doc_id]
        got[text] = [f"{k}:{text[int(a):int(b)]}" for k, a, b in (s.split(":") for s in r.spans)]
    assert got == {t: [s] if s else [] for t, s in want.items()} and queries.op6_pii


def test_clashing_names_give_way(spark, docs_of):
    docs = docs_of([(1, "some words"), (2, None)]).withColumns({"Base": F.lit(1), "n_ip": F.lit("x"), "extra": F.lit(7)})
    out = pii.spans(docs, pii.model(spark))
    assert [c.lower() for c in out.columns].count("base") == 1 and out.select("n_ip", "base", "extra").count() == 2


def test_html_inline_elements_and_authors_lists():
    extract = html_extract.extract
    para = "The committee met in the old town hall and agreed on what was to be done with the money that it had for the year."
    page = "<html><body><article><p>{}</p>" + f"<p>{para}</p>" * 3 + "{}</article>{}</body></html>"
    first = lambda html: extract(page.format(html, "", "")).split("\n")[0]
    assert first(f"{para} <svg><path d='x'/></svg> It goes on.") == f"{para} It goes on."
    assert first(f"{para} Press the <button>Start</button> key.") == f"{para} Press the key."
    assert first(f"{para} A long<wbr>word and a pic<img src=x>ture.") == f"{para} A longword and a picture."
    sources = "<h2>Sources</h2><ul><li><a href=/a>The first report of the committee</a></li><li><a href=/b>The second report</a></li></ul>"
    assert extract(page.format("It was so.", sources, "")).split("\n")[-2:] == ["The first report of the committee", "The second report"]
    card = "<article><h3><a href=/n>Another story of the day</a></h3><p>Read on about it.</p></article>"
    assert "Another story" not in extract(page.format("It was so.", "", card))
    thread = f"<div class='reader-opinions'><p>{para}</p><p>I do not agree with any of this, and I have said so before.</p></div>"
    assert "agree with any" not in extract(page.format("It was so.", thread, thread))


def test_licence_tags_and_other_languages(spark, docs_of):
    lines = {"// SPDX-License-Identifier: MIT": ["MIT"], "# SPDX-License-Identifier: GPL-3.0-or-later": ["GPL"],
             "SPDX-License-Identifier: Apache-2.0": ["Apache"], "Licensed under the EUPL, Version 1.2": ["EUPL"],
             "Distributed under the Boost Software License, Version 1.0.": ["Boost"],
             "Released under the Unlicense.": ["Unlicense"], "Lizenziert unter der Apache-Lizenz, Version 2.0.": ["Apache"],
             "The committee met in the hall and read the law.": []}
    docs = docs_of([(k, "some text here\n" + line) for k, line in enumerate(lines)])
    model = licences.learn(spark, docs_of([(1, "plain words of a text")]))
    got = {r.id: r.families for r in licences.scan(spark, docs, model).collect()}
    assert got == {k: f for k, f in enumerate(lines.values())}


def test_long_words_are_scored_without_the_cache():
    import numpy as np
    weight = np.random.default_rng(1).normal(size=quality.BUCKETS)
    model = quality.Model(weight)
    long = "x" * 50 + "y" * 200_000
    got = model.scorer()([f"some {long} words {long} {long}"])[0][0]
    buckets, counts = quality.document_counts(f"some {long} words {long} {long}")
    want = 1 / (1 + np.exp(-(model.weight[buckets].astype(float) * counts).sum() / counts.sum()))
    assert abs(got - want) < 1e-6 and long not in model.words and "some" in model.words


class _PlainBlocks(__import__("html.parser", fromlist=["HTMLParser"]).HTMLParser):
    """Text by block element, with Python's own parser: what the splitter must agree with."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.parts, self.hidden = [], [], 0

    def flush(self):
        text = " ".join("".join(self.parts).split())
        self.blocks += [text] * bool(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "svg", "button")
        if tag == "br" and not self.hidden:
            self.parts.append(" ")
        elif tag in ("p", "li", "ul", "h2", "div", "blockquote", "article", "td", "tr", "table"):
            self.flush()

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "svg", "button")
        if tag in ("p", "li", "ul", "h2", "div", "blockquote", "article", "td", "tr", "table"):
            self.flush()

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def test_block_splitter_agrees_with_a_plain_parser():
    rng = random.Random(12)
    words = "the of and to a in that it was for on are as with his they at be this have from or one had by but not what all were we when".split()
    inline = ["<b>{}</b>", "<em>{}</em>", "{}<br>", "<span class='x > y'>{}</span>", "<svg><path/></svg>{}", "<!-- note -->{}", "{}&amp;&nbsp;&#233;",
              "<button>Go</button> {}", "{}<wbr>", "<script>var a = '<p>' + 1 < 2;</script>{}", "{} 3 < 5 ", "\n\t{}  "]

    def run(n):
        return " ".join(rng.choice(inline).format(rng.choice(words)) if rng.random() < 0.25 else rng.choice(words) for _ in range(n))
    for _ in range(150):
        body = ""
        for _ in range(rng.randint(2, 9)):
            kind = rng.choice(["p", "p", "p", "h2", "blockquote", "div", "ul", "table"])
            inner = ("".join(f"<li>{run(rng.randint(8, 30))}</li>" for _ in range(3)) if kind == "ul" else
                     f"<tr><td>{run(20)}</td><td>{run(20)}</td></tr>" if kind == "table" else run(rng.randint(20, 60)))
            body += f"<{kind} id=k>{inner}</{kind}>"
        plain = _PlainBlocks()
        plain.feed(f"<article>{body}</article>")
        plain.flush()
        page = f"<html><head><title>t</title></head><body><nav><a href=/>home</a></nav><article>{body}</article><footer>the end of it all</footer></body></html>"
        assert html_extract.extract(page).split("\n") == plain.blocks


def test_languages_match_a_dense_nearest_centroid(spark, docs_of):
    """Predictions are those of all cosines, computed one by one in double precision from the model's centroids."""
    rng = random.Random(2)
    words = {"aa": "uno dos tres gato perro casa", "bb": "one two three cat dog house", "cc": "eins zwei drei katze hund haus"}
    docs = [(k, " ".join(rng.choices(words[lang].split(), k=rng.randint(3, 40))), lang) for k in range(240) for lang in [rng.choice(list(words))]]
    model = langid.learn(spark, docs_of(docs))
    texts = [t for _, t, _ in docs] + ["tres cat haus", "Zwei, drei!", "perro"]
    names, scores, rejected = model.predict(texts)
    for text, name, score, bad in zip(texts, names, scores, rejected):
        count = langid.counts(text)
        vector = np.where(count > 0, (1 + np.log(np.maximum(count, 1))) * model.idf.astype(float), 0)
        cosines = [sum(vector * centre) / np.sqrt(sum(vector ** 2)) for centre in model.centres.astype(float)]
        best = int(np.argmax(cosines))
        others = [c for c, o in zip(cosines, model.owner) if o != model.owner[best]]
        assert abs(score - max(cosines)) < 1e-4
        assert name == model.names[model.owner[best]] or max(cosines) - max(others) < 1e-4
        assert bad == (max(cosines) < model.floor[model.names.index(name), int((count > 0).sum()).bit_length()]) or abs(
            max(cosines) - model.floor[model.names.index(name), int((count > 0).sum()).bit_length()]) < 1e-4
    assert sum(n == lang for n, (_, _, lang) in zip(names, docs)) == len(docs)
    assert model.predict(["", None, "123"])[0] == ["und"] * 3
