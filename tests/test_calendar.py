"""Calendar day rules and zone rendering."""
import datetime as dt

from pyspark.sql import functions as F

from comms_lake.functions import times as TM
from comms_lake.operators import calendar as C

EV = "id string, start_ts timestamp_ntz, end_ts timestamp_ntz, all_day boolean"


def days_of(spark, rows, zone="UTC", cap=None):
    df = spark.createDataFrame(rows, EV)
    return {r["id"]: sorted(d for d in r["d"]) for r in
            C.event_days(df, zone, cap).groupBy("id").agg(F.collect_list(F.date_format("day", "MM-dd")).alias("d")).collect()}


def test_event_day_rules(spark):
    d = dt.datetime
    got = days_of(spark, [
        ("allday2", d(2024, 3, 3), d(2024, 3, 5), True),          # end exclusive
        ("midnight", d(2024, 3, 1, 22), d(2024, 3, 2, 0), False),   # midnight end is the previous day
        ("noend", d(2024, 3, 1, 10), None, False),
        ("backward", d(2024, 3, 1, 10), d(2024, 3, 1, 9), False),
        ("long", d(2024, 3, 1), d(2024, 6, 1), True),
    ])
    assert got["allday2"] == ["03-03", "03-04"]
    assert got["midnight"] == ["03-01"]
    assert got["noend"] == ["03-01"] and got["backward"] == ["03-01"]
    assert len(got["long"]) == 92
    capped = days_of(spark, [("long", d(2024, 3, 1), d(2024, 6, 1), True), ("short", d(2024, 3, 1), d(2024, 3, 3), True)], cap=60)
    assert len(capped["long"]) == 61 and len(capped["short"]) == 2


def test_zone_render_naive_utc(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 10, 20, 0),)], "ts timestamp_ntz")
    r = df.select(TM.hhmm("ts", "America/Bogota").alias("h"), TM.local_iso("ts", "America/Bogota").alias("iso"),
                  TM.digest_local("ts", "America/Bogota").alias("dg")).first()
    assert r["h"] == "1500" and r["iso"] == "2024-01-10T15:00:00-05:00" and r["dg"] == "2024-01-10 15:00"


def test_parse_graph_timestamps(spark):
    df = spark.createDataFrame([("2024-01-10T20:00:00.1234567",), ("2024-01-10T20:00:00Z",),
                                ("2024-01-10T15:00:00-05:00",), ("",), ("garbage",)], "s string")
    got = [r[0] for r in df.select(F.date_format(TM.parse_graph_ts(F.col("s")), "HH:mm:ss.SSSSSS")).collect()]
    assert got == ["20:00:00.123456", "20:00:00.000000", "20:00:00.000000", None, None]


def test_time_parsing_ignores_the_session_zone(spark):
    from comms_lake.operators import ops as O
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-03-10T02:30:00Z",), ("2024-03-10T02:30:00",), ("2024-11-03T01:30:00-04:00",)], "s string")
        got = [r[0] for r in df.select(F.substring(TM.wall(TM.parse_graph_ts(F.col("s"))), 9, 8)).collect()]
        assert got == ["10 02:30", "10 02:30", "03 05:30"]
        hint = [r[0] for r in df.select(O.graph_time_hint(F.col("s"), F.lit("utc"))).collect()]
        assert hint == ["2024-03-10T02:30:00Z", "2024-03-10T02:30:00Z", "2024-11-03T01:30:00-04:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    short = spark.createDataFrame([("2024-03-10",), ("2024-03-10T02:30",), ("2024-03-10 07",), ("2024-13-10",), ("x",)], "s string")
    assert [r[0] for r in short.select(O.graph_time_hint(F.col("s"), F.lit(""))).collect()] == [
        "2024-03-10T00:00:00Z", "2024-03-10T02:30:00Z", "2024-03-10T07:00:00Z", "2024-13-10", "x"]


def test_digest_time_of_another_zone_is_wall_time(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 10, 20), "UTC"), (dt.datetime(2024, 1, 10, 20), ""),
                                (dt.datetime(2024, 1, 10, 20), "Pacific Standard Time")], "ts timestamp_ntz, z string")
    got = [r[0] for r in df.select(TM.digest_local("ts", "America/Bogota", F.col("z"))).collect()]
    assert got == ["2024-01-10 15:00", "2024-01-10 15:00", "2024-01-10 20:00"]


def test_date_range_of_several_days(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 1), 1), (dt.date(2024, 3, 1), 3), (dt.date(2024, 3, 1), 0)], "d date, n int")
    assert [r[0] for r in df.select(TM.date_range_text(F.col("d"), F.col("n"))).collect()] == [
        "2024-03-01..2024-03-01", "2024-02-28..2024-03-01", "2024-03-01..2024-03-01"]


def test_attendee_cap(spark):
    df = spark.createDataFrame([([f"p{i}" for i in range(12)],), (["a", "b"],)], "l array<string>")
    assert [r[0] for r in df.select(C.attendee_cap(F.col("l"))).collect()][1] == "a, b"
    got = [r[0] for r in df.select(C.attendee_cap(F.col("l"), 10)).collect()]
    assert got == ["p0, p1, p2, p3, p4, p5, p6, p7, p8, p9 (+2 more)", "a, b"]


def test_day_document_exact_text(spark):
    from comms_lake.functions import people as P
    from comms_lake.operators import documents as DOC
    att = "array<struct<type:string,emailAddress:struct<name:string,address:string>>>"
    ev = spark.createDataFrame([(
        "cal", 0, "e1", "Sync", dt.datetime(2024, 3, 1, 9), dt.datetime(2024, 3, 1, 10), False, True,
        "https://teams.microsoft.com/x", True, "", "Ana", "Ana@x",
        [{"type": "required", "emailAddress": {"name": "luis@x", "address": "luis@x"}},
         {"type": "resource", "emailAddress": {"name": "Sala Norte", "address": "sala@x"}}], "Piso 3")],
        "calendar string, profile bigint, id string, subject string, start_ts timestamp_ntz, end_ts timestamp_ntz, "
        f"all_day boolean, cancelled boolean, join_url string, is_online boolean, provider string, org_name string, "
        f"org_address string, attendees {att}, location string")
    ev = C.with_people(ev).withColumns({
        "place": P.event_place(F.col("location"), F.col("attendees")),
        "teams": C.is_teams(F.col("join_url"), F.col("is_online"), F.col("provider")), "excerpt": F.lit("")})
    d = C.event_days(ev.withColumn("block", DOC.event_block()))
    empty = spark.createDataFrame([("cal", 0, dt.date(2024, 3, 2))], "calendar string, profile bigint, day date")
    rows = d.unionByName(empty, allowMissingColumns=True).withColumns(
        {"empresa": F.lit("acme"), "cuenta": F.lit("u@x")})
    docs = {r["day"].isoformat(): r["content"] for r in
            DOC.render_day(rows, ["calendar", "profile"], "2024-03-02T00:00:00+00:00").collect()}
    assert docs["2024-03-01"] == (
        '---\nfuente: calendario\nempresa: "acme"\ncuenta: "u@x"\nfecha: 2024-03-01T00:00:00+00:00\n'
        'creationDate: 2024-03-01\nid_origen:\n  - "e1"\nparticipantes:\n  - "Ana <ana@x>"\n  - "<luis@x>"\n'
        'asunto: "Agenda 2024-03-01"\nproyecto:\neventos: 1\ningestado: 2024-03-02T00:00:00+00:00\n---\n\n'
        "## 09:00–10:00 · Sync\n- id_origen: e1\n- organizador: Ana <ana@x>\n- participantes: Ana <ana@x>; <luis@x>\n"
        "- lugar: Piso 3; Sala Norte\n- teams: sí\n- estado: cancelado\n")
    assert docs["2024-03-02"].endswith("id_origen: []\nparticipantes: []\nasunto: \"Agenda 2024-03-02\"\nproyecto:\n"
                                       "eventos: 0\ningestado: 2024-03-02T00:00:00+00:00\n---\n\nSin eventos.\n")


DAY_COLS = ("calendar string, profile bigint, id string, subject string, start_ts timestamp_ntz, end_ts timestamp_ntz, "
            "all_day boolean, cancelled boolean, org_name string, org_address string, location string, version bigint, "
            "deleted boolean")


def day_rows(spark, rows):
    from comms_lake.operators import documents as DOC
    df = spark.createDataFrame([("cal", 0, i, sub, a, b, False, can, "Ana", "ana@x", loc, v, gone)
                                for i, sub, a, b, can, loc, v, gone in rows], DAY_COLS)
    att = F.array().cast("array<struct<type:string,emailAddress:struct<name:string,address:string>>>")
    df = C.with_people(df.withColumn("attendees", att)).withColumns(
        {"place": F.col("location"), "teams": F.lit(False), "excerpt": F.lit("")})
    return df.withColumn("block", DOC.event_block()).select(
        "calendar", "profile", "id", "k", "people", "people_keys", "block", "start_ts", "end_ts", "all_day", "version", "deleted")


def account(df):
    return df.withColumns({"empresa": F.lit("acme"), "cuenta": F.lit("u@x")})


def test_day_upsert_sees_edits_moves_deletions_and_replays(spark, tmp_path):
    from comms_lake.streaming.jobs import DayUpsertStream
    d = dt.datetime

    def row(i, sub="Sync", day=1, can=False, loc="", v=0, gone=False):
        return (i, sub, d(2024, 3, day, 9), d(2024, 3, day, 10), can, loc, v, gone)
    s = DayUpsertStream(spark, str(tmp_path), account, "I")

    def land(batch, *rows):
        s.process(day_rows(spark, rows), batch)
        return {r.day.day: (r.content_hash, r.written_batch, r.content) for r in
                spark.read.schema(s.DAYS).parquet(s.days_path).collect()}
    first = land(0, row("a"), row("b", day=2), row("c", day=3), row("x", day=4))
    assert sorted(first) == [1, 2, 3, 4] and all(v[1] == 0 for v in first.values())
    for batch, change in enumerate([row("a", sub="Renamed", v=1), row("a", sub="Renamed", loc="Piso 2", v=2),
                                    row("a", sub="Renamed", loc="Piso 2", can=True, v=3)], 1):
        before, after = first, land(batch, change)
        assert after[1][0] != before[1][0] and after[1][1] == batch
        assert all(after[k] == before[k] for k in (2, 3, 4))      # byte for byte, as they were written
        first = after
    moved = land(4, row("b", day=5, v=1))                         # leaves day 2, comes to day 5
    assert "Sin eventos." in moved[2][2] and "- id_origen: b" in moved[5][2] and moved[3] == first[3]
    gone = land(5, row("c", day=3, v=1, gone=True))
    assert "eventos: 0" in gone[3][2] and gone[3][1] == 5
    same = land(6, row("x", day=4))                               # redelivered unchanged: nothing is rewritten
    assert same == gone
    # a crash after the events were written and before the marker: the replay changes nothing
    import shutil
    shutil.copytree(tmp_path / "events" / "batch=6", tmp_path / "events" / "batch=7")
    replayed = land(7, row("x", day=4))
    assert replayed == gone and "eventos: 1" in replayed[4][2]


def test_changed_days_labels(spark):
    cols = "calendar string, profile bigint, day date, content_hash string"
    new = spark.createDataFrame([("c", 0, dt.date(2024, 3, k), h) for k, h in ((1, "a"), (2, "b"), (3, "c"))], cols)
    old = spark.createDataFrame([("c", 0, dt.date(2024, 3, 1), "a"), ("c", 0, dt.date(2024, 3, 2), "z")], cols)
    got = {r.day.day: r.change for r in C.changed_days(new, old, ["calendar", "profile"]).collect()}
    assert got == {2: "changed", 3: "new"}


def long_events(spark, n=40, days=60):
    from comms_lake.operators import documents as DOC
    rows = [(k % 3, f"e{k}", dt.datetime(2024, 1, 1 + k % 20), dt.datetime(2024, 1, 1 + k % 20) + dt.timedelta(days=1 + k * days // n),
             k % 2 == 0) for k in range(n)] + [(None, "late", dt.datetime(1969, 12, 20), dt.datetime(1970, 1, 4), True),
                                               (0, "never", None, None, False)]
    df = spark.createDataFrame(rows, "profile long, id string, start_ts timestamp_ntz, end_ts timestamp_ntz, all_day boolean")
    who = F.concat(F.lit("P <p"), F.col("id"), F.lit("@x>"))
    return C.with_sort_key(df.withColumns({
        "people": F.array(who, F.lit("All <all@x>")), "people_keys": F.array(F.concat(F.lit("p"), F.col("id"), F.lit("@x")), F.lit("all@x")),
        "block": F.concat(F.lit("## "), "id"), "empresa": F.lit("acme"), "cuenta": F.lit("u@x")}))


def shuffled_rows(df):
    """Rows written to shuffles by ``df`` (collected)."""
    def walk(node):
        m = node.metrics()
        own = m.get("shuffleRecordsWritten").get().value() if m.contains("shuffleRecordsWritten") else 0
        return own + sum(walk(node.children().apply(i)) for i in range(node.children().size()))
    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def test_agendas_do_not_shuffle_a_row_a_day(spark):
    from comms_lake.operators import digest as D
    from comms_lake.operators import documents as DOC
    e, keys = long_events(spark).cache(), ["profile"]
    b, every = C.event_day_bounds(e), C.event_days(e)
    plain = {(r.profile, r.day): r.ids for r in every.groupBy(*keys, "day").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "id"))), lambda x: x["id"]).alias("ids")).collect()}
    n_events, n_days = e.count(), every.count()
    rollup, people = C.day_rollup(b, keys), C.day_people(b, keys)
    digest = D.calendar_digest(b.withColumns({"days": F.lit(1), **{c: F.lit("") for c in (
        "subject", "organizer_txt", "location", "join_url", "body_text")}, "cancelled": F.lit(False),
        "attendees_txt": F.col("people")}), keys, "I")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (rollup, people, digest):
            assert shuffled_rows(df) <= n_events * (60 // C.STRETCH_DAYS + 2) < n_days
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert {(r.profile, r.day): r.ids for r in rollup.collect()} == plain
    assert {(r.profile, r.day): len(r.people) - 1 for r in people.collect()} == {k: len(v) for k, v in plain.items()}
    assert {(r.profile, r.target_date): r.event_count for r in digest.collect()} == {(p, d.isoformat()): len(v) for (p, d), v in plain.items()}
    # documents: the days of the listed ranges, with events or not, the same as from one row a day
    spine = C.spine_ranges(b, keys).withColumns({"empresa": F.lit("acme"), "cuenta": F.lit("u@x"),
                                                 "last_day": F.date_add("last_day", 40)})
    days = spine.withColumn("day", F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY")))).drop("first_day", "last_day")
    want = DOC.render_day(every.unionByName(days, allowMissingColumns=True), keys, "I")
    got = DOC.render_ranges(b, spine, keys, "I")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_changed_days_of_two_snapshots(spark, tmp_path):
    """Events with event_id % 9 = 4 are new: their days, and days that only they bring into a calendar's range."""
    from comms_lake.plans import calendar_queries as CQ
    d = dt.datetime
    none = "array<struct<type:string,emailAddress:struct<name:string,address:string>>>"
    v = type("V", (), {})()
    rows = [(1, 1, d(2024, 1, 1), d(2024, 1, 3)), (4, 1, d(2024, 1, 6), d(2024, 1, 8)), (2, 1, d(2024, 1, 2), d(2024, 1, 3)),
            (13, 1, d(2024, 1, 2), d(2024, 1, 3)), (22, 2, d(2024, 3, 1), d(2024, 3, 2)), (3, 3, d(2024, 1, 1), d(2024, 1, 2))]
    e = spark.createDataFrame(rows, "event_id long, profile long, start_ts timestamp_ntz, end_ts timestamp_ntz").withColumns({
        "calendar": F.lit("c"), "id": F.concat(F.lit("e"), F.col("event_id").cast("string")), "subject": F.lit("S"), "all_day": F.lit(True),
        "cancelled": F.lit(False), "join_url": F.lit(""), "is_online": F.lit(False), "provider": F.lit(""), "org_name": F.lit("Ana"),
        "org_address": F.lit("ana@x"), "attendees": F.array().cast(none), "location": F.lit("")})
    v.timed, v.spans = e, e.limit(0)
    before, CQ.TestViews = CQ.TestViews, lambda spark, sf_dir: v
    try:
        got = {(r.profile, r.day): r.change for r in CQ.q_changed_days(spark, "").collect()}
    finally:
        CQ.TestViews = before
    assert got == {(1, "2024-01-02"): "changed", (2, "2024-03-01"): "new",
                   **{(1, f"2024-01-0{k}"): "new" for k in range(3, 8)}}


def test_day_runs_are_the_days_with_the_same_events(spark):
    """What a day shows is worked out once a run: fewer rows than days, the same events a day."""
    b, keys = C.event_day_bounds(long_events(spark)).cache(), ["profile"]
    plain = {(r.profile, r.day): r.ids for r in C.event_days(b).groupBy(*keys, "day").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "id"))), lambda x: x["id"]).alias("ids")).collect()}
    runs = [(r.profile, r.first_day, r.last_day, [e.id for e in r["__e"]]) for r in C.day_runs(b, keys, ["k", "id"]).collect()]
    assert len(runs) < len(plain) / 2
    days = [((p, lo + dt.timedelta(days=k)), ids) for p, lo, hi, ids in runs for k in range((hi - lo).days + 1)]
    assert len(days) == len(plain) and dict(days) == plain
    # days of listed ranges only, with events or not; a range's mark
    d = dt.date
    listed = spark.createDataFrame([(0, d(2024, 1, 10), d(2024, 5, 10), False), (0, d(2024, 1, 20), d(2024, 1, 21), True),
                                    (7, d(2024, 1, 1), d(2024, 1, 2), True)], "profile long, first_day date, last_day date, old boolean")
    got = {(r.profile, r.day): ([e.id for e in r["__e"]], r.old) for r in
           C.each_day(C.day_runs(b, keys, ["k", "id"], listed, "old")).collect()}
    want = [(0, d(2024, 1, 10) + dt.timedelta(days=k)) for k in range(122)] + [(7, d(2024, 1, 1)), (7, d(2024, 1, 2))]
    assert got == {at: (plain.get(at, []), at[0] == 7 or at[1] in (d(2024, 1, 20), d(2024, 1, 21))) for at in want}


def test_a_digest_and_a_document_are_joined_once_a_run(spark):
    """Sections and lists are made before a run's days are: no list of entries reaches the last expansion."""
    from comms_lake.operators import digest as D
    from comms_lake.operators import documents as DOC
    b, keys = C.event_day_bounds(long_events(spark)), ["profile"]
    digest = D.calendar_digest(b.withColumns({"days": F.lit(1), **{c: F.lit("") for c in (
        "subject", "organizer_txt", "location", "join_url", "body_text")}, "cancelled": F.lit(False),
        "attendees_txt": F.col("people")}), keys, "I")
    spine = C.spine_ranges(b, keys).withColumns({"empresa": F.lit("acme"), "cuenta": F.lit("u@x")})
    for df in (digest, DOC.render_ranges(b, spine, keys, "I"), C.day_people(b, keys, C.attendee_cap)):
        plan = df._jdf.queryExecution().optimizedPlan().toString().split("Generate explode(")
        last = next(part for part in plan[1:] if "sequence(first_day" in part or "INTERVAL '1' DAY" in part)
        assert "__e" not in last.split("]", 1)[0] and "__s" not in last.split("]", 1)[0] and "inline(" in last


def test_changed_days_stores_no_rendered_events(spark, monkeypatch):
    """Both snapshots come from one group: what is stored on the way has no text of an event."""
    from comms_lake.plans import calendar_queries as CQ
    stored, materialize = [], CQ.materialize
    monkeypatch.setattr(CQ, "materialize", lambda df, name="stage": stored.append(df.columns) or materialize(df, name))
    test_changed_days_of_two_snapshots(spark, None)
    assert stored and not {"block", "people", "people_keys"} & {c for columns in stored for c in columns}
