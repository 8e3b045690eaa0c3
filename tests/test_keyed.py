"""Keyed state: exclusion memory (T5), strikes (T6) and lateness (T3) over scheduled runs."""
import datetime as dt
import os
import time

from comms_lake.streaming import keyed as K

EXCLUDED = [("junk",)]


def land(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def by_run(stream, *columns):
    out = {}
    for r in stream.events().collect():
        out.setdefault(r.run, set()).add(tuple(r[c] for c in columns))
    return out


def test_memory_rescues_forgets_and_goes_on_after_a_restart(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "state")
    bad = spark.createDataFrame(EXCLUDED, "folder_id string")
    box = {(1, "a"): "junk", (1, "b"): "junk", (2, "a"): "junk"}

    def mailbox():
        return spark.createDataFrame([(p, i, f) for (p, i), f in box.items()] or [(0, "", "")], "profile bigint, id string, folder_id string")

    def stream():  # a new object each time, as after a restart: all state is in the checkpoint
        return K.exclusion_memory(spark, root, landing, mailbox, bad)
    land(spark, landing, [(1, "a", "excluded"), (1, "b", "excluded"), (2, "a", "excluded"), (1, "a", "excluded")], K.MEMORY_ROWS)
    stream().run()
    box[1, "a"] = "inbox"
    del box[1, "b"]
    time.sleep(0.1)
    stream().run()   # timers ask, the sink looks up
    time.sleep(0.1)
    stream().run()   # answers
    got = by_run(stream(), "profile", "id", "action")
    assert got[0] == {(1, "a", "remembered"), (1, "b", "remembered"), (2, "a", "remembered")}
    assert got[1] == {(1, "a", "recheck"), (1, "b", "recheck"), (2, "a", "recheck")}
    assert {x for x in got[2] if x[2] != "recheck"} == {(1, "a", "rescued"), (1, "b", "forgotten"), (2, "a", "rechecked")}
    land(spark, landing, [(1, "a", "excluded")], K.MEMORY_ROWS)   # thrown away again
    box[1, "a"] = "junk"
    stream().run()
    assert (1, "a", "remembered") in by_run(stream(), "profile", "id", "action")[3]


def test_memory_expires_and_keeps_the_newest(spark, tmp_path):
    landing = str(tmp_path / "in")
    bad = spark.createDataFrame(EXCLUDED, "folder_id string")
    mailbox = lambda: spark.createDataFrame([(1, f"m{k}", "junk") for k in range(9)], "profile bigint, id string, folder_id string")
    land(spark, landing, [(1, f"m{k}", "excluded") for k in range(5)], K.MEMORY_ROWS)
    short = K.exclusion_memory(spark, str(tmp_path / "short"), landing, mailbox, bad, keep_ms=1500)
    newest = K.exclusion_memory(spark, str(tmp_path / "newest"), landing, mailbox, bad, keep_max=3, per_run=2)
    short.run()
    newest.run()
    time.sleep(2)
    land(spark, landing, [(1, f"m{k}", "excluded") for k in (0, 7)], K.MEMORY_ROWS)
    short.run()
    newest.run()
    got = by_run(short, "id", "action")
    assert (got[0], got[1]) == ({(f"m{k}", "remembered") for k in range(5)}, {("m0", "remembered"), ("m7", "remembered")})
    got = by_run(newest, "id", "action")
    assert sum(a == "pruned" for _, a in got[0]) == 2
    # m0 and m1 were pruned as the oldest (equal times go by id), so m0 is new again and two make place
    assert {x for x in got[1] if x[1] != "recheck"} == {("m0", "remembered"), ("m7", "remembered"), ("m2", "pruned"), ("m3", "pruned")}
    assert {x for x in got[1] if x[1] == "recheck"} == {("m4", "recheck")}


def test_a_failure_that_clears_before_the_third_run_is_written(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "state")
    tries = []

    def attempt(asked):
        """m1 works at its second try, m2 never; ``old`` had two strikes before."""
        tries.append(sorted(r.id for r in asked.collect()))
        return asked.selectExpr("profile", "id", "id = 'm1' AND n = 1 AS ok", "concat('timeout ', n) AS reason")

    def stream():
        return K.strike_counter(spark, root, landing, attempt)
    land(spark, landing, [(1, "m1", False, "busy", 0), (1, "m2", False, "busy", 0), (1, "m2", False, "busy", 0), (1, "old", False, "busy", 2)],
         K.STRIKE_ROWS)
    for _ in range(4):
        stream().run()
        time.sleep(0.05)
    events = stream().events()
    got = by_run(stream(), "id", "action", "n", "reason")
    assert got[0] == {("m1", "failed", 1, "busy"), ("m2", "failed", 1, "busy"), ("old", "skipped", 3, "busy")}  # one strike for two listings
    assert ("m1", "written", 2, None) in got[2] and ("m2", "failed", 2, "timeout 1") in got[2]
    ends = {(r.id, r.action): r for r in events.filter("action IN ('written', 'skipped')").collect()}
    assert tries[1] == ["m1", "m2"] and ("m1", "skipped") not in ends
    for _ in range(2):
        stream().run()
        time.sleep(0.05)
    ends = {(r.id, r.action): r for r in stream().events().filter("action IN ('written', 'skipped')").collect()}
    assert set(ends) == {("m1", "written"), ("m2", "skipped"), ("old", "skipped")}
    assert ends["m2", "skipped"].reason == "timeout 2" and ends["m2", "skipped"].at > ends["old", "skipped"].at


def test_lateness_is_judged_per_profile(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "state")
    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)

    def stream():
        return K.late_filter(spark, root, landing, dt.timedelta(minutes=10))
    rows = [[(1, "a", early), (2, "a", late)], [(1, "b", early + dt.timedelta(hours=1)), (2, "b", late - dt.timedelta(days=3)), (1, "a", early)]]
    for part in rows:  # two files in the first run: order does not matter
        land(spark, landing, part, K.LATE_ROWS)
    stream().run()
    land(spark, landing, [(1, "c", early + dt.timedelta(minutes=55)), (1, "d", early), (2, "c", late - dt.timedelta(days=1)),
                          (2, "a", late), (2, "e", late + dt.timedelta(days=9)), (3, "a", early), (3, "n", None)], K.LATE_ROWS)
    stream().run()
    got = by_run(stream(), "profile", "id", "action")
    assert got[0] == {(1, "a", "new"), (2, "a", "new"), (1, "b", "new"), (2, "b", "new")}
    assert got[1] == {(1, "c", "new"), (1, "d", "late"), (2, "c", "late"), (2, "e", "new"), (3, "a", "new"), (3, "n", "new")}
    before = sorted(map(tuple, stream().events().collect()))
    stream()._land(spark.createDataFrame([(9, "x", early, "new")], K.LateFilter.SCHEMA), 1)  # a replayed run changes nothing
    assert sorted(map(tuple, stream().events().collect())) == before and not os.path.exists(f"{root}/marks/run-2")


def test_state_is_a_call_a_bucket_and_not_a_call_an_id():
    """10,000 ids of one bucket: a list is read once and written once a run."""
    from types import SimpleNamespace as N

    class State(list):
        calls = 0

        def get(self):
            self.calls += 1
            return iter(list(self))

        def put(self, rows):
            self.calls += 1
            self[:] = rows

        def appendList(self, rows):
            self.calls += 1
            self.extend(rows)

        def clear(self):
            self.calls += 1
            del self[:]

    state, timers = State(), []
    handle = N(getListState=lambda name, schema, ttl=None: state, listTimers=lambda: iter(timers), registerTimer=timers.append)
    at = lambda ms: N(getCurrentProcessingTimeInMs=lambda: ms)
    late = K.LateFilter(dt.timedelta(minutes=10), keep_ms=1000)
    late.init(handle)
    day = dt.datetime(2024, 1, 1)
    rows = [N(profile=k % 7, id=f"m{k}", received=day, mark=None) for k in range(10_000)]
    assert len(list(late.handleInputRows((0,), iter(rows + rows), at(0)))) == 10_000 and state.calls == 2
    assert list(late.handleInputRows((0,), iter(rows[:5]), at(900))) == []  # renewed: they end later than the others
    ends = [r.id for r in late.handleInputRows((0,), iter(rows[:6]), at(1500))]
    assert ends == ["m5"] and len(state) == 6 and state.calls == 6          # the ended ones left the list
    for k in range(20):  # a list of renewals is rewritten
        list(late.handleInputRows((0,), iter(rows[:6]), at(1501 + k)))
    assert len(state) <= 12

    state = State()
    memory = K.ExclusionMemory(keep_ms=1000)
    memory.init(handle)
    rows = [N(profile=k % 7, id=f"m{k}", event="excluded") for k in range(10_000)]
    assert len(list(memory.handleInputRows((0,), iter(rows), at(0)))) == 10_000 and state.calls == 2
    asked = list(memory.handleExpiredTimer((0,), at(1), None))
    assert len(asked) == 10_000 and state.calls == 3 and {r.action for r in asked} == {"recheck"}
    answers = [N(profile=k % 7, id=f"m{k}", event=("normal", "gone", "still")[k % 3]) for k in range(9_999)]
    said = [r.action for r in memory.handleInputRows((0,), iter(answers), at(2))]
    assert [said.count(x) for x in ("rescued", "forgotten", "rechecked")] == [3333] * 3 and len(state) == 3334
    assert list(memory.handleExpiredTimer((0,), at(1000), None)) == [] and state == []
