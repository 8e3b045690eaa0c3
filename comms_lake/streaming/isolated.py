"""One streaming query per source, side by side.

Sources fail alone: each is a query with its own checkpoint, so a source that
fails mid-stream keeps what it committed and goes on from there in the next
run, while the others drain. A listener gathers what the engine reports of
each query; a run appends one status row a source to the run log (K6), with a
short label and never an exception's message.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

LOG = "run bigint, source string, rows bigint, batches bigint, status string"
REPORTS_WITHIN = 60  # seconds that the engine's last reports may take


class Reports(StreamingQueryListener):
    """Rows and batches that each query committed, and whether it ended with an error."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self.errors: dict[str, str | None] = {}
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self.changed:
            key, n = str(event.progress.runId), event.progress.numInputRows
            self.rows[key] = self.rows.get(key, 0) + n
            self.batches[key] = self.batches.get(key, 0) + (n > 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.errors[str(event.runId)] = event.exception
            self.changed.notify_all()

    def wait(self, run_ids: list[str]) -> None:
        with self.changed:
            self.changed.wait_for(lambda: all(r in self.errors for r in run_ids), REPORTS_WITHIN)


def label(error: str) -> str:
    """The class of the last cause that an error names."""
    named = re.findall(r"\b([A-Z][A-Za-z]*(?:Error|Exception))\b", error)
    return named[-1] if named else "Error"


def run_sources(spark: SparkSession, sources: dict[str, Callable[[], StreamingQuery]], log: str, run: int) -> DataFrame:
    """One run of all sources at the same time; returns the run log so far.
    ``sources`` maps a name to a function that starts its query
    (``trigger(availableNow=True)``, a checkpoint of its own)."""
    reports, started, status = Reports(), {}, {}
    spark.streams.addListener(reports)
    try:
        for name, start in sorted(sources.items()):
            try:
                started[name] = start()
            except Exception as error:  # noqa: BLE001 - a source that cannot start must not stop the others
                status[name] = f"error: {type(error).__name__}"
        for name, query in started.items():
            try:
                query.awaitTermination()
                status[name] = "ok"
            except StreamingQueryException as error:
                status[name] = f"error: {label(str(error))}"
        reports.wait([str(q.runId) for q in started.values()])
    finally:
        spark.streams.removeListener(reports)
    key = {name: str(q.runId) for name, q in started.items()}
    rows = [(run, name, reports.rows.get(key.get(name), 0), reports.batches.get(key.get(name), 0), status[name]) for name in sorted(sources)]
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(log)
    return spark.read.schema(LOG).parquet(log)
