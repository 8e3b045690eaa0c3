"""Incremental mail stream: one outcome per id, third strike to the skip
list, and a replay of a finished stream writes nothing new (T1, T4, T6)."""
import datetime as dt
import os
import time

import pytest

from comms_lake.streaming import jobs as J

COLS = "profile bigint, id string, internet_id string, received timestamp_ntz, folder_id string, subject string, " \
       "event_id bigint, user_id bigint, k bigint, pos int"


FOLDERS = [("root", "r", "root"), ("inbox", "i", "root"), ("junkemail", "j", "root")]


def stream(spark, root, fails, files, **options):
    folders = spark.createDataFrame(FOLDERS, "folder_id string, display_name string, parent_id string")
    f = spark.createDataFrame(fails, "profile bigint, id string, prior_strikes bigint")
    start = spark.createDataFrame([(dt.datetime(2024, 2, 1),)], "backfill_start timestamp_ntz")
    s = J.MailStream(spark, os.path.join(root, "state"), folders, ["junkemail"], f, 10, start, **options)
    s.drain(spark.readStream.schema(COLS).option("maxFilesPerTrigger", files).parquet(os.path.join(root, "landing")))
    return s


def land(spark, root, rows, days):
    """One file a day, landed in time order."""
    for day in sorted({r[3].date() for r in rows}):
        part = [r for r in rows if r[3].date() == day]
        spark.createDataFrame(part, COLS).coalesce(1).write.mode("append").parquet(os.path.join(root, "landing"))
        time.sleep(0.05)


def messages():
    t0, rows = dt.datetime(2024, 3, 1, 9), []
    for day in range(3):
        for i in range(12):
            n = day * 100 + i
            folder = "junkemail" if i == 5 else "inbox"
            inet = f"<same{day}>" if i in (3, 4) else "" if i >= 6 else f"<m{n}>"
            rows.append((n % 2, f"m{n}", inet, t0 + dt.timedelta(days=day, minutes=i), folder, "s", n, 1, 1, 0))
    rows.append((1, "again", "<m1>", t0 + dt.timedelta(days=2, hours=3), "inbox", "s", 1, 1, 1, 0))  # a copy two days later
    return rows


@pytest.mark.parametrize("files", [1, 99])
def test_every_id_gets_an_outcome_for_any_split_into_batches(spark, tmp_path, files):
    rows = messages()
    land(spark, str(tmp_path), rows, 3)
    # profile 0 fails for a whole day: more than five in a row, so the run stops and goes on in the next
    fails = [(0, f"m{100 + i}", 0) for i in range(0, 12, 2) if i not in (4,)] + [(1, "m7", 1)]
    s = stream(spark, str(tmp_path), fails, files)
    got = {r["id"]: r["outcome"] for r in s.final_outcomes().collect()}
    want = {}
    written = {}
    for p, i, inet, at, folder, *_ in sorted(rows, key=lambda r: (r[0], r[3], r[1])):
        bad = (p, i) in {(a, b) for a, b, _ in fails}
        if inet and (p, inet) in written:
            want[i] = "known"
        elif folder == "junkemail":
            want[i] = "excluded"
        elif bad:
            want[i] = "skipped"
        else:
            want[i] = "written"
            written[p, inet] = i
    assert got == want
    index = s.tables["index"].read()
    assert index.count() == index.select("profile", "id").distinct().count()
    before = s.outcomes().count()
    s2 = stream(spark, str(tmp_path), fails, files)                 # same checkpoint: nothing left to do
    assert s2.outcomes().count() == before


def test_a_replayed_batch_writes_the_same_state(spark, tmp_path):
    batch = spark.createDataFrame(messages(), COLS)
    folders = spark.createDataFrame(FOLDERS, "folder_id string, display_name string, parent_id string")
    none = spark.createDataFrame([], "profile bigint, id string, prior_strikes bigint")
    start = spark.createDataFrame([(dt.datetime(2024, 2, 1),)], "backfill_start timestamp_ntz")
    s = J.MailStream(spark, str(tmp_path / "state"), folders, ["junkemail"], none, 10, start, cap=5)
    s.process(batch, 0)
    while s.pending():                                              # several capped runs
        s.process(None, s.runs())
    assert s.outcomes().select("run").distinct().count() > 1
    first = sorted(map(tuple, s.outcomes().collect()))
    last = s.runs() - 1
    (tmp_path / "state" / "done" / f"batch={last}").rename(tmp_path / "marker")   # as after a crash before the commit
    s.process(None, last)
    assert sorted(map(tuple, s.outcomes().collect())) == first
    assert {r["outcome"] for r in s.final_outcomes().collect()} == {"written", "excluded", "known"}


def test_a_failure_that_clears_is_written_and_one_that_stays_is_dated(spark, tmp_path):
    """One try a run: an outage over one run costs one strike, not three."""
    land(spark, str(tmp_path), messages(), 3)
    folders = spark.createDataFrame(FOLDERS, "folder_id string, display_name string, parent_id string")
    start = spark.createDataFrame([(dt.datetime(2024, 2, 1),)], "backfill_start timestamp_ntz")

    def fails(run):
        rows = [(0, "m2", 0, "disk full")] + [(0, "m0", 0, "timeout"), (1, "m7", 0, "timeout")] * (run < 2)
        return spark.createDataFrame(rows, "profile bigint, id string, prior_strikes bigint, reason string")
    s = J.MailStream(spark, str(tmp_path / "state"), folders, ["junkemail"], fails, 10, start)
    live = spark.readStream.schema(COLS).parquet(str(tmp_path / "landing"))
    s.run(live)
    got = {r.id: r.outcome for r in s.final_outcomes().collect()}
    assert [got[i] for i in ("m0", "m7", "m2")] == ["failed"] * 3 and s.runs() == 1
    s.run(live)
    s.run(live)
    got = {r.id: r.outcome for r in s.final_outcomes().collect()}
    assert [got[i] for i in ("m0", "m7", "m2")] == ["written", "written", "skipped"] and not s.pending()
    dead = s.skip_list().collect()
    assert [(r.profile, r.id, r.reason) for r in dead] == [(0, "m2", "disk full")] and dead[0].at[:4] == str(dt.date.today().year)
    s.run(live)
    assert s.runs() == 3                                            # nothing landed, nothing left


def test_state_is_compacted(spark, tmp_path):
    """What a run reads does not grow with the runs before it; a replayed run reads and writes the same."""
    from pyspark.sql import functions as F

    from comms_lake.sources.runs import RunTable
    t = RunTable(spark, str(tmp_path / "ids"), "profile bigint, id string, run bigint, bucket int", every=4)
    rows = lambda run: spark.range(6).select((F.col("id") % 3).alias("profile"), F.concat(F.lit(f"r{run}-"), F.col("id").cast("string")).alias("id"))
    files = []
    for run in range(19):
        assert t.read(run).count() == 6 * run and t.read(run, [0]).where("bucket <> 0").isEmpty()
        t.save(rows(run), run, (F.col("profile") % 2).cast("int"))
        t.save(rows(run), run, (F.col("profile") % 2).cast("int"))  # a replay
        t.compact(run)
        files.append(len(t.read().inputFiles()))
    assert max(files[-8:]) == max(files[4:12]) <= 10 and t.base() == 15
    assert t.read().count() == t.read().distinct().count() == 114
    assert sorted(t.read().where("run = 3").select("id").distinct().collect()) == sorted(rows(3).select("id").collect())
    (spark.range(1).write.parquet(str(tmp_path / "ids" / "bases" / "upto=18")))  # a base without its pointer never counts
    assert t.read().count() == 114


def test_a_late_older_version_of_an_event_changes_nothing(spark, tmp_path):
    from pyspark.sql import functions as F

    from comms_lake.operators import calendar as C
    from comms_lake.plans import calendar_queries as CQ
    rows = [("e1", "New title", 2, 0), ("e1", "Old title", 1, 1), ("e2", "Only", 1, 1), ("e1", "Newest", 3, 2)]
    sf = "/root/testdata/sf0.001"
    from comms_lake.sources.testdata import TestViews
    TestViews(spark, sf).timed.orderBy("id").limit(1).write.parquet(str(tmp_path / "event"))
    event = spark.read.parquet(str(tmp_path / "event"))
    s = J.DayUpsertStream(spark, str(tmp_path / "days"), CQ.account, CQ.INGESTADO)
    seen = []
    for number in range(3):
        batch = None
        for ident, subject, version, at in rows:
            if at == number:
                row = CQ.day_rows(C.with_people(event.withColumns({"id": F.lit(ident), "subject": F.lit(subject)})))
                row = row.withColumn("version", F.lit(version).cast("bigint"))
                batch = row if batch is None else batch.unionByName(row)
        s.process(batch, number)
        days = spark.read.schema(s.DAYS).parquet(s.days_path).collect()
        seen.append({(t in d.content) for d in days for t in ("Old title",)} | {t for d in days for t in ("New title", "Newest", "Only") if t in d.content})
    assert seen == [{False, "New title"}, {False, "New title", "Only"}, {False, "Newest", "Only"}]


def test_one_failing_source_leaves_the_others(spark):
    profiles = spark.createDataFrame([(0,), (1,)], "profile bigint")

    def broken():
        raise OSError("secret detail")
    out = J.run_isolated(spark, profiles, {"mail": lambda: spark.createDataFrame([(0, 3)], "profile bigint, n bigint"),
                                           "calendar": broken}, describe=lambda e: type(e).__name__)
    assert {(r.profile, r.source): (r.status, r.n) for r in out.collect()} == {
        (0, "mail"): ("ok", 3), (1, "mail"): ("error: sin datos", 0),
        (0, "calendar"): ("error: OSError", 0), (1, "calendar"): ("error: OSError", 0)}
