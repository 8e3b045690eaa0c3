"""S1 + T2: the continuation link as offset."""
import json

from comms_lake.sources import paged as P


def land(root, scan, pages, first=0, more=False):
    folder = root / "in" / scan
    folder.mkdir(parents=True, exist_ok=True)
    for k, items in enumerate(pages):
        last = k == len(pages) - 1 and not more
        page = {"value": items} | ({} if last else {"@odata.nextLink": f"{first + k + 1}"})
        (folder / f"{first + k}.json").write_text(json.dumps(page), encoding="utf-8-sig" if k == 0 else "utf-8")


def items(df):
    return sorted((r.scan, r.page, r.pos, json.loads(r.item)["id"]) for r in df.collect())


def test_same_rows_for_any_trigger_size_and_restart_at_the_link(spark, tmp_path):
    pages = {"a": [[{"id": f"a{k}-{i}"} for i in range(5)] for k in range(6)], "b": [[{"id": "b0"}], [], [{"id": "ñ"}]], "c": [[]]}
    for scan, p in pages.items():
        land(tmp_path, scan, p)
    want = sorted((s, k, i, x["id"]) for s, p in pages.items() for k, page in enumerate(p) for i, x in enumerate(page))
    for size in (1, 7, 1000):
        got = P.drain_pages(spark, str(tmp_path / "in"), str(tmp_path / f"out{size}"), size)
        assert items(got) == want, size
        per = got.groupBy("batch").count().collect()
        assert max(r["count"] for r in per) < size + 5  # whole pages
    # one run at a time: a new query goes on at the links; a page that lands later is read then
    land(tmp_path, "d", [[{"id": "d0"}, {"id": "d1"}]], more=True)
    root = str(tmp_path / "out-d")
    for _ in range(4):
        got = P.drain_pages(spark, str(tmp_path / "in"), root, 1000, runs=1)
    assert len(items(got)) == len(want) + 2
    land(tmp_path, "d", [[{"id": "d2"}]], first=1)
    got = P.drain_pages(spark, str(tmp_path / "in"), root, 1000, runs=2)
    assert items(got) == sorted(want + [("d", 0, 0, "d0"), ("d", 0, 1, "d1"), ("d", 1, 0, "d2")])


def test_a_batch_logs_its_own_links_and_is_replayed_from_them(tmp_path):
    for k in range(60):
        land(tmp_path, f"s{k:02}", [[{"id": f"{k}-{p}-{i}"} for i in range(2)] for p in range(3)])
    walk = P.PageWalk(str(tmp_path / "in"), 6, str(tmp_path / "links"))
    at, rows, batches = walk.initialOffset(), [], []
    while True:
        got, end = walk.read(at)
        if end == at:
            break
        batches.append((at, end, list(got)))
        rows += batches[-1][2]
        assert len(json.dumps(end)) < 30  # not a link a scan
        at = end
    assert len(batches) == 60 and len(set(rows)) == len(rows) == 360
    logged = [len(json.loads((tmp_path / "links" / f"{n + 1}.json").read_text())["links"]) for n in range(60)]
    assert sum(logged) <= 3 * 60  # grows with the pages, not with scans times batches
    for start, end, want in batches:  # a new process
        again = P.PageWalk(str(tmp_path / "in"), 6, str(tmp_path / "links"))
        assert sorted(again.readBetweenOffsets(start, end)) == sorted(want)
        assert again.read(end)[1] == ({"number": end["number"] + 1} if end != at else end)


def test_one_query_drains_all_batches(spark, tmp_path, monkeypatch):
    from pyspark.sql.streaming import DataStreamWriter
    land(tmp_path, "a", [[{"id": f"a{k}"}] for k in range(5)])
    starts, start = [], DataStreamWriter.start
    monkeypatch.setattr(DataStreamWriter, "start", lambda self, *a, **k: starts.append(1) or start(self, *a, **k))
    got = P.drain_pages(spark, str(tmp_path / "in"), str(tmp_path / "out"), 1)
    assert got.count() == 5 and got.select("batch").distinct().count() == 5 and len(starts) == 1
