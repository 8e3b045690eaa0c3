"""S1 + T2: a paged listing as a streaming source whose offset is the continuation link.

Each scan (one mailbox or calendar) lists its items in pages; a page names the
next one by a link, so a scan can only be walked in order. A micro-batch walks
the scans from their links until it has ``rowsPerTrigger`` items (whole pages, one
at least). The links where it stopped are the batch's end offset: the offset in the query's
checkpoint is the number of a file of the links log, which holds the links that moved in
that batch, or now and then all of them. So a batch costs what it reads, however many scans
there are. A restart resumes at those links. A link whose page has not landed yet is asked
for again when the known scans are done, or in the next run; scans that land
meanwhile are found then, too. A page without a link ends its scan.

The walk goes through the driver, as links are known one after the other, and
holds ``rowsPerTrigger`` items at most beyond a page, and the scans' links. Large backlogs that lie in files already are
read by the file stream (``landed.page_schema``) instead.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from .files import _store

PAGED = "comms_paged_listing"
ROWS = "scan string, page bigint, pos int, item string"
FIRST = "0"


class PageWalk(SimpleDataSourceStreamReader):
    def __init__(self, path: str, rows_per_trigger: int, log: str):
        self.path, self.limit, self.log = path, rows_per_trigger, log
        self.number: int | None = None  # of the offset that ``links`` belongs to
        self.links: dict[str, list] = {}  # scan: link, pages read
        self.base = self.moved = 0  # the last file with all links; links logged since
        self.queue: deque[str] = deque()

    def initialOffset(self) -> dict:
        return {"number": 0}

    def _entry(self, number: int) -> dict:
        store, root = _store(self.log)
        with store.open_input_stream(f"{root}/{number}.json") as f:
            return json.loads(f.read())

    def _links(self, number: int) -> tuple[dict[str, list], int, int]:
        """All links at an offset, the file with all links that they follow from, and the links logged since."""
        if number == 0:
            return {}, 0, 0
        base, links, moved = self._entry(number)["base"], {}, 0
        for n in range(max(base, 1), number + 1):
            entry = self._entry(n)["links"]
            links |= entry
            moved += len(entry) if n > base else 0
        return links, base, moved

    def _save(self, number: int, moved: dict[str, list]) -> None:
        """A number that no batch was planned for, as its query ended, is written again."""
        self.links |= moved
        self.moved += len(moved)
        whole = self.moved > len(self.links)  # so all files together grow with the pages
        if whole:
            self.base, self.moved = number, 0
        store, root = _store(self.log)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/_{number}.json") as f:
            f.write(json.dumps({"base": self.base, "links": self.links if whole else moved}).encode())
        store.move(f"{root}/_{number}.json", f"{root}/{number}.json")
        self.number = number

    def _refresh(self, store: pafs.FileSystem, root: str) -> None:
        """The scans that are not done; the one that waits longest goes first: fewest pages read so far."""
        scans = [f.base_name for f in store.get_file_info(pafs.FileSelector(root, allow_not_found=True))
                 if f.type == pafs.FileType.Directory and not f.base_name.startswith(("_", "."))]
        at = {s: self.links.get(s, [FIRST, 0]) for s in scans}
        self.queue = deque(sorted((s for s in scans if at[s][0]), key=lambda s: (at[s][1], s)))

    def _page(self, store: pafs.FileSystem, root: str, scan: str, link: str) -> dict | None:
        name = f"{root}/{scan}/{link}.json"
        if store.get_file_info(name).type == pafs.FileType.NotFound:
            return None
        with store.open_input_stream(name) as page:
            return json.loads(page.read().decode("utf-8-sig"))

    def _walk(self, scan: str, at: list, rows: list[tuple], go_on) -> tuple[list, bool]:
        """Adds a scan's items to ``rows`` while ``go_on``; where it stopped, and whether a page was missing."""
        store, root = _store(self.path)
        while at[0] and go_on(at):
            page = self._page(store, root, scan, at[0])
            if page is None:
                return at, True
            rows += [(scan, at[1], pos, json.dumps(item, ensure_ascii=False)) for pos, item in enumerate(page.get("value") or [])]
            at = [page.get("@odata.nextLink") or "", at[1] + 1]
        return at, False

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        number = start["number"]
        if self.number != number:
            self.links, self.base, self.moved = self._links(number)
            self.number, self.queue = number, deque()
        rows: list[tuple] = []
        moved: dict[str, list] = {}
        fresh = False
        while len(rows) < self.limit:
            if not self.queue:
                if fresh or moved:
                    break
                self._refresh(*_store(self.path))
                fresh = True
                continue
            scan = self.queue.popleft()
            before = self.links.get(scan, [FIRST, 0])
            at, missing = self._walk(scan, before, rows, lambda _: len(rows) < self.limit)
            if at != before:
                moved[scan] = at
            if at[0] and not missing:
                self.queue.append(scan)
        if not moved:
            return iter(()), start
        self._save(number + 1, moved)
        return iter(rows), {"number": number + 1}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        links, until = self._links(start["number"])[0], {}
        for n in range(start["number"] + 1, end["number"] + 1):
            until |= self._entry(n)["links"]
        rows: list[tuple] = []
        for scan, stop in until.items():
            self._walk(scan, links.get(scan, [FIRST, 0]), rows, lambda at, stop=stop: at != stop)
        return iter(rows)


class PagedListing(DataSource):
    """Options: ``path`` (a folder of ``<scan>/<link>.json`` envelopes; the first link is 0), ``rowsPerTrigger``
    and ``links`` (the folder of the links log, of one checkpoint alone)."""

    @classmethod
    def name(cls) -> str:
        return PAGED

    def schema(self) -> str:
        return ROWS

    def simpleStreamReader(self, schema) -> PageWalk:
        return PageWalk(self.options["path"], int(self.options.get("rowsPerTrigger", 1000)), self.options["links"])


def paged_stream(spark: SparkSession, path: str, rows_per_trigger: int, links: str) -> DataFrame:
    """A streaming frame of (scan, page, pos, item as JSON text); ``links`` is the folder of its links log."""
    spark.dataSource.register(PagedListing)
    return (spark.readStream.format(PAGED).option("path", path).option("rowsPerTrigger", rows_per_trigger)
            .option("links", links).load())


def drain_pages(spark: SparkSession, path: str, root: str, rows_per_trigger: int, runs: int | None = None) -> DataFrame:
    """Runs of one batch each into a table; returns it. All that is there, in one query, or
    ``runs`` scheduled ones, each a query of its own (``availableNow`` gives a Python source one batch)."""
    out = f"{root}/items"

    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")  # a replay overwrites

    sink = (paged_stream(spark, path, rows_per_trigger, f"{root}/links").writeStream.foreachBatch(land)
            .option("checkpointLocation", f"{root}/checkpoint"))
    if runs is None:
        query = sink.start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    for _ in range(runs or 0):
        sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(f"{ROWS}, batch int").parquet(out)
