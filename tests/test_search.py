"""the positional index finds what the scan finds."""
import re

from comms_lake.operators import mail as M
from comms_lake.operators import search as S


def test_index_equals_the_scan_and_reads_only_its_terms(spark, tmp_path):
    texts = ["The plan for the river bank", "A river-bank plan; the  plan", "no such thing", None, "THE PLAN, for Ñandú birds",
             "explain for them", "plan for", "the plan for\nthe plan for the planet"]
    docs = spark.createDataFrame([(k, t, texts[-1 - k]) for k, t in enumerate(texts)], "id bigint, subject string, body string")
    root = str(tmp_path / "index")
    S.add_batch(docs.where("id < 5"), root, 0)
    S.add_batch(docs.where("id >= 5"), root, 1)
    S.add_batch(docs.where("id >= 5"), root, 1)  # replaced, not doubled
    for phrase in ("plan", "the plan", "an for the", "plan for the plan", "river bank", "river-bank", "the  plan", "PLAN, FOR ñandú", "lan for", "zebra",
                   "no such thing", "for\nthe"):
        want = sorted(r.id for r in M.phrase_search(docs, phrase).collect())
        assert sorted(r.id for r in S.search(docs, root, phrase).collect()) == want, phrase
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = S.postings_of(spark, root, ["x", "plan", "y"], 1)._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PartitionFilters: \[.*bucket", plan) and "EqualTo(term,plan)" in plan


def test_positions_of_a_text_are_grouped_without_a_shuffle(spark, tmp_path, monkeypatch):
    from collections import defaultdict
    monkeypatch.setattr(S, "WORDS", 5)
    words = [["a", "b", "a", "c"], [], ["a"] * 9, ["b", "ñ"], ["c"], []]
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"id": [str(k) for k in range(len(words))], "field": ["body"] * len(words),
                                        "words": pa.array(words, pa.list_(pa.string()))})
    got = {(r["term"], r["id"]): r["positions"] for b in S._positions(iter([batch, batch.slice(3)])) for r in b.to_pylist()}
    want = defaultdict(list)
    for k, ws in enumerate(words):
        for at, w in enumerate(ws):
            want[w, str(k)].append(at)
    assert got == want
    seen = []
    write = type(spark.range(1).write).parquet
    monkeypatch.setattr(type(spark.range(1).write), "parquet", lambda self, path, *a, **k: (
        seen.append(self._df._jdf.queryExecution().optimizedPlan().toString()), write(self, path, *a, **k))[1])
    S.add_batch(spark.createDataFrame([(1, "x y x", None), (None, "x", "z")], "id int, subject string, body string"), str(tmp_path), 0)
    assert "Aggregate" not in seen[0] and "MapInArrow" in seen[0]
    rows = spark.read.parquet(f"{tmp_path}/postings").collect()
    assert sorted((r.term, r.id or "", r.field, tuple(r.positions)) for r in rows) == [
        ("x", "", "subject", (0,)), ("x", "1", "subject", (0, 2)), ("y", "1", "subject", (1,)), ("z", "", "body", (0,))]
