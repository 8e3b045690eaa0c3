"""Keyed state inside a stream: exclusion memory (T5), strikes (T6) and
lateness per profile (T3), each an arbitrary stateful operator on RocksDB.

A scheduled run is one micro-batch (``trigger(once=True)``): it takes the rows
that landed, the answers to what the run before asked for, and the timers that
are due. Timers ask (``recheck``, ``retry``); the sink of the same run finds the
answers, by a join with the mailbox or by trying the write again, and lands them
as input of the next run. So a failing write is tried once a run, whatever else
the run does, and time passes between the tries.

Every run's events and answers lie under its number and are overwritten when a
run is replayed; the checkpoint holds state, timers and offsets, so a new
process goes on where the last one ended.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..session import bounded
from ..sources.landed import path_exists

ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
DAY_MS = 24 * 3600 * 1000
STRIKES = 3
BUCKETS = 16_384  # keys of the state whose rows need no whole profile; a checkpoint keeps its number


def _bucket():
    return F.pmod(F.xxhash64("profile", "id"), F.lit(BUCKETS))


def _now(timer_values) -> dt.datetime:
    return dt.datetime.fromtimestamp(timer_values.getCurrentProcessingTimeInMs() / 1000)


# a timer is set one millisecond ahead at least: one that is due already would fire, and be deleted, in the same run


class ExclusionMemory(StatefulProcessor):
    """T5: ids found in an excluded folder, per key ``part``: a bucket of ids, or a
    whole profile. A key's ids are one list, read and written in one call each.

    An id is forgotten ``keep_ms`` after it was first seen (a re-check does not
    renew it); ``checked`` says when it was last looked up. A timer asks for the
    ``per_run`` least recently checked ids (all by default); ``keep_max`` keeps
    the newest so many. Both need keys that are whole profiles."""

    SCHEMA = "profile bigint, id string, action string, at timestamp"

    def __init__(self, keep_ms: int = 7 * DAY_MS, every_ms: int = 0, per_run: int | None = None, keep_max: int | None = None):
        self.keep_ms, self.every_ms, self.per_run, self.keep_max = keep_ms, every_ms, per_run, keep_max

    def init(self, handle) -> None:
        self.handle = handle
        self.ids = handle.getListState("ids", "profile bigint, id string, since bigint, checked bigint")

    def _live(self, now_ms: int) -> tuple[dict, bool]:
        """(profile, id) -> (since, checked) of what is remembered; whether the list holds more."""
        rows = list(self.ids.get())
        live = {(p, i): (since, checked) for p, i, since, checked in rows if now_ms < since + self.keep_ms}
        return live, len(live) < len(rows)

    def _store(self, live: dict) -> None:
        if live:
            self.ids.put([(*ident, *times) for ident, times in live.items()])
        else:
            self.ids.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now, now_ms = _now(timerValues), timerValues.getCurrentProcessingTimeInMs()
        live, changed = self._live(now_ms)

        def said(ident: tuple, action: str) -> Row:
            return Row(profile=ident[0], id=ident[1], action=action, at=now)

        for row in rows:
            ident = (row.profile, row.id)
            known = live.get(ident)
            if row.event == "excluded" and known is None:
                live[ident], changed = (now_ms, now_ms), True
                yield said(ident, "remembered")
            elif known is not None and row.event == "still":
                live[ident], changed = (known[0], now_ms), True
                yield said(ident, "rechecked")
            elif known is not None and row.event in ("normal", "gone"):
                del live[ident]
                changed = True
                yield said(ident, "rescued" if row.event == "normal" else "forgotten")
        if self.keep_max is not None:
            oldest = sorted((since, ident[1], ident) for ident, (since, _) in live.items())
            for _, _, ident in oldest[:max(0, len(oldest) - self.keep_max)]:
                del live[ident]
                changed = True
                yield said(ident, "pruned")
        if changed:
            self._store(live)
        if live and next(iter(self.handle.listTimers()), None) is None:
            self.handle.registerTimer(now_ms + max(1, self.every_ms))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, now_ms = _now(timerValues), timerValues.getCurrentProcessingTimeInMs()
        live, stale = self._live(now_ms)
        due = [ident for ident, (since, _) in live.items() if since < now_ms]  # not those first seen in this run
        if self.per_run is not None:
            due = sorted(due, key=lambda ident: (live[ident][1], ident[1]))[:self.per_run]
        for ident in due:
            yield Row(profile=ident[0], id=ident[1], action="recheck", at=now)
        if stale:
            self._store(live)
        if live:
            self.handle.registerTimer(now_ms + max(1, self.every_ms))

    def close(self) -> None:
        pass


class StrikeCounter(StatefulProcessor):
    """Failing writes, per (profile, id). A run counts one strike however
    often it met the row; a write clears it; the third strike gives the id
    up, with the run's time and the reason of the last failure (K7)."""

    SCHEMA = "profile bigint, id string, action string, n int, reason string, at timestamp"

    def __init__(self, strikes: int = STRIKES, every_ms: int = 0):
        self.strikes, self.every_ms = strikes, every_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("strikes", "n int, reason string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        tries = list(rows)  # of one id in one run: its listings and the answer
        n = (self.state.get()[0] if self.state.exists() else tries[0].before or 0) + 1
        done = any(r.ok for r in tries)
        reason = None if done else max(r.reason or "" for r in tries)
        action = "written" if done else "skipped" if n >= self.strikes else "failed"
        if action == "failed":
            self.state.update((n, reason))
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + max(1, self.every_ms))
        else:
            self.state.clear()
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        yield Row(profile=key[0], id=key[1], action=action, n=n, reason=reason, at=_now(timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.state.exists():
            n, reason = self.state.get()
            yield Row(profile=key[0], id=key[1], action="retry", n=n, reason=reason, at=_now(timerValues))

    def close(self) -> None:
        pass


class LateFilter(StatefulProcessor):
    """Copies and late rows, per (profile, id). Each row carries its
    profile's own mark (the greatest time that earlier runs accepted), so a
    profile that is ahead makes no other profile's rows late. A copy renews
    what is remembered of its id, which ends ``keep_ms`` after the last one.

    A key is a bucket of ids. What it remembers is one list, read in one call; a run appends
    what it learns in another, so neither is a call an id. The list is
    rewritten when most of it has ended or was renewed."""

    SCHEMA = "profile bigint, id string, received timestamp_ntz, action string"

    def __init__(self, lateness: dt.timedelta, keep_ms: int = 7 * DAY_MS):
        self.lateness, self.keep_ms = lateness, keep_ms

    def init(self, handle) -> None:
        # time to live clears buckets that no row reaches any more; ``until`` is exact after a rewrite too
        self.seen = handle.getListState("seen", "profile bigint, id string, until bigint", self.keep_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        firsts: dict = {}
        for r in rows:
            order, ident = (r.received is None, r.received), (r.profile, r.id)
            if ident not in firsts or order < firsts[ident][0]:
                firsts[ident] = (order, r.mark)
        now_ms = timerValues.getCurrentProcessingTimeInMs()
        stored = list(self.seen.get())
        seen = {}
        for profile, ident, until in stored:
            seen[profile, ident] = max(until, seen.get((profile, ident), until))
        seen = {ident: until for ident, until in seen.items() if until > now_ms}
        learned = []
        for ident, ((_, received), mark) in firsts.items():
            known = ident in seen
            late = not known and mark is not None and received is not None and received < mark - self.lateness
            if not late:
                learned.append((*ident, now_ms + self.keep_ms))
            if not known:
                yield Row(profile=ident[0], id=ident[1], received=received, action="late" if late else "new")
        seen.update({(profile, ident): until for profile, ident, until in learned})
        if len(stored) + len(learned) > 2 * len(seen):
            self.seen.put([(*ident, until) for ident, until in seen.items()]) if seen else self.seen.clear()
        elif learned:
            self.seen.appendList(learned)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from ()

    def close(self) -> None:
        pass


class ScheduledStream:
    """Scheduled runs of one stateful processor over files that land.

    ``landing`` holds Parquet files of ``schema``; ``prepare`` makes the keyed
    rows of a run; ``answer`` turns a run's requests into rows of ``schema``
    for the next run; ``ended`` is called with a run's stored events."""

    def __init__(self, spark: SparkSession, root: str, landing: str, schema: str, keys: list[str], processor,
                 prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows, requests: tuple[str, ...] = (),
                 answer: Callable[[DataFrame], DataFrame] | None = None, ended: Callable[[DataFrame, int], None] | None = None):
        self.spark, self.root, self.landing, self.schema, self.keys = spark, root, landing, schema, keys
        self.processor, self.prepare, self.requests, self.answer, self.ended = processor, prepare, requests, answer, ended
        self.events_path, self.answers = os.path.join(root, "events"), os.path.join(root, "answers")

    def _files(self, path: str) -> DataFrame:
        hpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hpath)
        return self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true").parquet(path)

    def _land(self, batch: DataFrame, number: int) -> None:
        marker = os.path.join(self.root, "done", f"run-{number}")
        if path_exists(self.spark, marker):  # a replay of a run that had ended
            return
        here = os.path.join(self.events_path, f"run={number}")
        batch.write.mode("overwrite").parquet(here)
        events = self.spark.read.schema(batch.schema).parquet(here)
        if self.answer is not None:
            asked = events.filter(F.col("action").isin(*self.requests))
            answers = self.answer(asked).select(*self._columns())
            answers.write.mode("overwrite").parquet(os.path.join(self.answers, f"run-{number}"))
        if self.ended is not None:
            self.ended(events, number)
        self.spark.range(1).write.mode("overwrite").parquet(marker)

    def _columns(self) -> list[str]:
        return [c.strip().split()[0] for c in self.schema.split(",")]

    def run(self) -> None:
        """One scheduled run."""
        rows = self._files(self.landing)
        if self.answer is not None:
            rows = rows.unionByName(self._files(self.answers))
        out = self.prepare(rows).groupBy(*self.keys).transformWithState(
            statefulProcessor=self.processor, outputStructType=self.processor.SCHEMA, outputMode="Append", timeMode="ProcessingTime")
        before = {k: self.spark.conf.get(k, None) for k in ROCKSDB}
        for k, v in ROCKSDB.items():
            self.spark.conf.set(k, v)
        try:
            query = (out.writeStream.foreachBatch(self._land).outputMode("append").trigger(once=True)
                     .option("checkpointLocation", os.path.join(self.root, "_checkpoint")).start())
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
        query.awaitTermination()

    def events(self) -> DataFrame:
        """All events so far, with their run."""
        return self.spark.read.schema(f"{self.processor.SCHEMA}, run int").parquet(self.events_path)


MEMORY_ROWS = "profile bigint, id string, event string"
STRIKE_ROWS = "profile bigint, id string, ok boolean, reason string, before int"
LATE_ROWS = "profile bigint, id string, received timestamp_ntz"


def exclusion_memory(spark: SparkSession, root: str, landing: str, mailbox: Callable[[], DataFrame],
                     excluded_folders: DataFrame, **limits) -> ScheduledStream:
    """T5 over landed rows (profile, id, event = excluded): what is
    remembered is looked up in ``mailbox()`` (profile, id, folder_id) as it
    is then. An id that has left the excluded folders is rescued, one that is
    gone is forgotten. Limits hold for a whole profile, so keys are buckets of ids
    only without them."""
    whole = limits.get("per_run") is not None or limits.get("keep_max") is not None
    part = F.col("profile") if whole else _bucket()

    def answer(asked: DataFrame) -> DataFrame:
        now = mailbox().select("profile", "id", "folder_id", F.lit(True).alias("there"))
        bad = excluded_folders.select("folder_id", F.lit(True).alias("bad"))
        found = asked.select("profile", "id").join(now, ["profile", "id"], "left").join(bounded(bad), "folder_id", "left")
        return found.select("profile", "id", F.when(F.col("there").isNull(), F.lit("gone"))
                            .when(F.col("bad"), F.lit("still")).otherwise(F.lit("normal")).alias("event"))

    return ScheduledStream(spark, root, landing, MEMORY_ROWS, ["part"], ExclusionMemory(**limits),
                           lambda rows: rows.withColumn("part", part), ("recheck",), answer)


def strike_counter(spark: SparkSession, root: str, landing: str, attempt: Callable[[DataFrame], DataFrame],
                   **limits) -> ScheduledStream:
    """T6 over landed failures (profile, id, ok, reason, before: strikes of
    earlier runs); ``attempt`` tries the writes (profile, id, n) again and
    returns (profile, id, ok, reason)."""
    return ScheduledStream(spark, root, landing, STRIKE_ROWS, ["profile", "id"], StrikeCounter(**limits), requests=("retry",),
                           answer=lambda asked: attempt(asked).withColumn("before", F.lit(0)))


def late_filter(spark: SparkSession, root: str, landing: str, lateness: dt.timedelta, **limits) -> ScheduledStream:
    """T3 over landed rows (profile, id, received): the first copy of each id,
    unless it is further behind its profile's mark than ``lateness``; such rows
    are ``late`` events, a table beside the accepted ones. Marks move when a
    run ends, so the split of a run into files does not matter."""
    path = os.path.join(root, "marks")

    def marked(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("bucket", _bucket())
        if not path_exists(spark, path):
            return rows.withColumn("mark", F.lit(None).cast("timestamp_ntz"))
        marks = (spark.read.schema("profile bigint, mark timestamp_ntz").option("recursiveFileLookup", "true").parquet(path)
                 .groupBy("profile").agg(F.max("mark").alias("mark")))
        return rows.join(bounded(marks), "profile", "left")

    def ended(events: DataFrame, number: int) -> None:
        (events.filter("action = 'new' AND received IS NOT NULL").groupBy("profile").agg(F.max("received").alias("mark"))
         .write.mode("overwrite").parquet(os.path.join(path, f"run-{number}")))

    return ScheduledStream(spark, root, landing, LATE_ROWS, ["bucket"], LateFilter(lateness, **limits), marked, ended=ended)
