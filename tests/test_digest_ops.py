"""Exact digest text and operations rules, written from the reference's
rendering and lookup rules (independent of the DuckDB oracles)."""
import datetime as dt

from pyspark.sql import functions as F

from comms_lake.operators import digest as D
from comms_lake.operators import ops as O
from comms_lake.sources import landed as L

ITEMS = ("profile bigint, scope string, target_date date, days int, received timestamp_ntz, id string, "
         "sender string, to array<string>, cc array<string>, subject string, body_text string, categories array<string>")


def test_mail_digest_exact_text(spark):
    items = spark.createDataFrame([(0, "Inbox", dt.date(2024, 3, 1), 1, dt.datetime(2024, 3, 1, 9, 0), "m1",
                                    "Ana <ana@x>", ["Luis <luis@x>"], [], "Hola", "cuerpo", [])], ITEMS)
    r = D.mail_digest(items, ["profile"], "2024-03-02T00:00:00+00:00", excerpt_chars=500).first()
    assert r["path"] == "External Inputs/Outlook/Mail/inbox/2024-03-01.md"
    assert r["content"] == (
        "---\ntype: external-input\nsource: outlook\nkind: mail\nfolder_or_query: Inbox\nscope_kind: folder\n"
        "date_range: 2024-03-01..2024-03-01\nmessage_count: 1\ningested_at: 2024-03-02T00:00:00+00:00\n"
        "entity_ids:\n  outlook:\n    - m1\n---\n\n# Outlook mail folder Inbox, 2024-03-01 to 2024-03-01\n\n"
        "_Messages in this digest: 1._\n"
        "## 2024-03-01 09:00 Ana <ana@x>\n\n- **Subject:** Hola\n- **To:** Luis <luis@x>\n"
        "- **Outlook message ID:** `m1`\n\n### Body excerpt (max 500 chars)\n\ncuerpo\n")


def test_query_scope_kind_and_slug(spark):
    df = spark.createDataFrame([("from:ana",), ("Inbox",), ('"big deal"',)], "s string")
    got = [(r[0], r[1]) for r in df.select(D.scope_kind(F.col("s")), D.scope_slug(F.col("s"), D.scope_kind(F.col("s")))).collect()]
    assert got[0][0] == "query" and got[0][1].startswith("query-") and len(got[0][1]) == 14
    assert got[1] == ("folder", "inbox") and got[2][0] == "query"


def test_error_triage_longer_code_first(spark):
    logs = spark.createDataFrame([(1, "x AADSTS500113: no reply"), (2, "AADSTS5001131 odd"), (3, "AADSTS50011 uri"),
                                  (4, "timeout")], "log_id bigint, body string")
    got = {r["log_id"]: r["code"] for r in O.error_triage(logs).collect()}
    assert got == {1: "AADSTS500113", 2: "AADSTS500113", 3: "AADSTS50011", 4: None}


def test_scope_check(spark):
    grants = spark.createDataFrame([(1, "https://graph.microsoft.com/Mail.Read"), (1, " user.read "), (1, "openid"),
                                    (2, None)], "user_id bigint, scope string")
    got = {r["user_id"]: (r["ok"], r["missing"]) for r in
           O.scope_check(grants, ["User.Read", "Mail.Read", "Mail.Send", "offline_access"]).collect()}
    assert got == {1: (False, "Mail.Send"), 2: (True, "")}       # an empty grant passes


def test_run_log_round_trip(spark, tmp_path):
    runs = spark.createDataFrame([("2024-03-01T09:00:00+00:00", "acme", 3, 16, 1, "1 sin datos de Teams", "ok", []),
                                  ("2024-03-01T09:30:00+00:00", "", 0, 16, 0, "", "error: 2 correos sin escribir",
                                   ["tope de 1000 mensajes alcanzado, continúa en la siguiente"])],
                                 "when string, perfil string, correo_nuevos bigint, calendario_dias bigint, "
                                 "reuniones bigint, reuniones_nota string, estado string, notas array<string>")
    lines = [r[0] for r in runs.select(L.run_log_line(runs)).collect()]
    assert lines[0] == ("2024-03-01T09:00:00+00:00 | acme | correo 3 nuevos | calendario 16 días | "
                        "reuniones 1 (1 sin datos de Teams) | estado ok")
    assert lines[1].endswith("| - | correo 0 nuevos | calendario 16 días | reuniones 0 | estado error: 2 correos "
                             "sin escribir; tope de 1000 mensajes alcanzado, continúa en la siguiente")
    path = str(tmp_path / "runlog")
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    back = {r["perfil"]: r for r in L.read_run_log(spark, path).collect()}
    assert back["acme"]["correo_nuevos"] == 3 and back["acme"]["reuniones_nota"] == "1 sin datos de Teams"
    assert back["-"]["estado"] == "error: 2 correos sin escribir" and len(back["-"]["notas"]) == 1


def test_calendar_digest_exact_text(spark):
    schema = ("profile bigint, target_date date, days int, start_ts timestamp_ntz, end_ts timestamp_ntz, id string, "
              "subject string, cancelled boolean, organizer_txt string, attendees_txt array<string>, location string, "
              "join_url string, body_text string")
    ev = spark.createDataFrame([(0, dt.date(2024, 3, 1), 1, dt.datetime(2024, 3, 1, 9), dt.datetime(2024, 3, 1, 10),
                                 "e1", "Reunión", True, "Ana <ana@x>", [f"p{i}" for i in range(12)], "Sala 1", "", "")],
                               schema)
    r = D.calendar_digest(ev, ["profile"], "2024-03-02T00:00:00+00:00", excerpt_chars=400, shown=10).first()
    assert r["path"] == "External Inputs/Outlook/Calendar/2024-03-01.md"
    assert r["content"] == (
        "---\ntype: external-input\nsource: outlook\nkind: calendar\ndate_range: 2024-03-01..2024-03-01\n"
        "event_count: 1\ningested_at: 2024-03-02T00:00:00+00:00\nentity_ids:\n  outlook_event:\n    - e1\n---\n\n"
        "# Outlook calendar, 2024-03-01 to 2024-03-01\n\n"
        "_Events in this digest: 1._\n"
        "## 2024-03-01 09:00 Reunión (cancelled)\n\n- **Start:** 2024-03-01 09:00\n- **End:** 2024-03-01 10:00\n"
        "- **Organizer:** Ana <ana@x>\n- **Attendees:** p0, p1, p2, p3, p4, p5, p6, p7, p8, p9 (+2 more)\n"
        "- **Location:** Sala 1\n- **Event ID:** `e1`\n\n### Body excerpt (max 400 chars)\n\n_(body unavailable)_\n")


def test_meetings_digest_exact_text(spark):
    schema = ("profile bigint, target_date date, days int, start_ts timestamp_ntz, end_ts timestamp_ntz, id string, "
              "subject string, organizer_txt string, attendees_txt array<string>, join_url string, meeting_id string, "
              "body_text string, transcripts array<struct<transcript_id:string,created:timestamp_ntz,vtt:string>>")
    vtt = "WEBVTT\n\n00:00:01.000 --> 00:00:02.000\n<v Ana>hola</v>"
    d, t = dt.date(2024, 3, 1), dt.datetime
    m = spark.createDataFrame([
        (0, d, 1, t(2024, 3, 1, 9), t(2024, 3, 1, 10), "e1", "Sync", "Ana <ana@x>", [], "https://teams.microsoft.com/x",
         "om1", "", [{"transcript_id": "t1", "created": t(2024, 3, 1, 10, 5), "vtt": vtt}]),
        (0, d, 1, t(2024, 3, 1, 11), t(2024, 3, 1, 11, 30), "e2", "Otra", "", [], "", None, "", None)], schema)
    r = D.meetings_digest(m, ["profile"], "2024-03-02T00:00:00+00:00").first()
    assert (r["meeting_count"], r["transcript_count"]) == (2, 1)
    assert r["content"] == (
        "---\ntype: external-input\nsource: outlook\nkind: meetings\ndate_range: 2024-03-01..2024-03-01\n"
        "meeting_count: 2\ntranscript_count: 1\ningested_at: 2024-03-02T00:00:00+00:00\nentity_ids:\n"
        "  outlook_event:\n    - e1\n    - e2\n---\n\n# Teams meetings + transcripts, 2024-03-01 to 2024-03-01\n\n"
        "_Meetings in this digest: 2, transcripts: 1 (whole, as WebVTT)._\n"
        "## 2024-03-01 09:00 Sync\n\n- **Start:** 2024-03-01 09:00\n- **End:** 2024-03-01 10:00\n"
        "- **Organizer:** Ana <ana@x>\n- **Teams join:** https://teams.microsoft.com/x\n- **Event ID:** `e1`\n"
        "- **Online meeting ID:** `om1`\n- **Transcripts available:** 1\n\n### Transcript 1 (2024-03-01 10:05)\n\n"
        "- **Transcript ID:** `t1`\n\n```vtt\n" + vtt + "\n```\n\n"
        "## 2024-03-01 11:00 Otra\n\n- **Start:** 2024-03-01 11:00\n- **End:** 2024-03-01 11:30\n"
        "- **Organizer:** (unknown organizer)\n- **Event ID:** `e2`\n- **Transcripts available:** 0\n")


def test_excerpts_and_caps_are_parameters(spark):
    long = "x" * 700
    items = spark.createDataFrame([(0, "Inbox", dt.date(2024, 3, 1), 1, dt.datetime(2024, 3, 1, 9, i), f"m{i}", "", [], [], "", long, [])
                                   for i in range(3)], ITEMS)
    whole = D.mail_digest(items, ["profile"], "I").first()["content"]
    assert whole.count(long) == 3 and "### Body excerpt\n" in whole and "[...truncated]" not in whole
    cut = D.mail_digest(D.newest_per_scope(items, ["profile", "scope"], 2), ["profile"], "I", excerpt_chars=500).first()
    assert cut["message_count"] == 2 and cut["content"].count("[...truncated]") == 2 and "m0" not in cut["content"]
    ev = spark.createDataFrame([(0, i, dt.datetime(2024, 3, 1, 9 + i)) for i in range(3)], "profile bigint, id int, start_ts timestamp_ntz")
    assert {r["id"] for r in D.earliest_per_scope(ev, ["profile"], 2).collect()} == {0, 1}
    assert D.earliest_per_scope(ev, ["profile"]).count() == 3


def test_digest_store_overwrites_one_scope_and_date(spark, tmp_path):
    cols = "kind string, target_date string, path string, content string"
    first = spark.createDataFrame([("mail", "2024-03-01", "a.md", "1"), ("mail", "2024-03-01", "b.md", "1"),
                                   ("mail", "2024-03-02", "a.md", "1"), ("calendar", "2024-03-01", "a.md", "1")], cols)
    L.write_digests(first, str(tmp_path / "s"))
    again = spark.createDataFrame([("mail", "2024-03-01", "a.md", "2")], cols)
    got = {(r.kind, r.target_date, r.path): r.content for r in L.write_digests(again, str(tmp_path / "s")).collect()}
    assert got == {("mail", "2024-03-01", "a.md"): "2", ("mail", "2024-03-01", "b.md"): "1",
                   ("mail", "2024-03-02", "a.md"): "1", ("calendar", "2024-03-01", "a.md"): "1"}


def test_page_budget_marks_cut_scans(spark, tmp_path):
    rows = ['{"scan":"s","page":%d,"value":[{"id":"e%d"}]%s}' % (p, p, ',"@odata.nextLink":"n"' if p < 2 else "") for p in range(3)]
    spark.createDataFrame([(r,) for r in rows], "value string").write.text(str(tmp_path / "p"))
    pages = L.read_pages(spark, str(tmp_path / "p"), L.EVENT)
    whole, cut = L.scan_caps(pages).first(), L.scan_caps(pages, 2).first()
    assert (whole.pages_read, whole.items_read, whole.capped) == (3, 3, False)
    assert (cut.pages_read, cut.items_read, cut.capped) == (2, 2, True)
    assert {r.item.id for r in L.page_items(pages).collect()} == {"e0", "e1", "e2"}


def test_frontmatter_lists_and_line_limit(spark):
    from comms_lake.operators import documents as DOC
    text = '---\na: "x\\ty"\nl:\n  - "one"\n  - two "b" \\ c\nempty: []\nz: plain\n---\nbody: no\n'
    df = spark.createDataFrame([(text,), ("no header\n",)], "content string")
    got = {r.key: (r.value, r["items"]) for r in DOC.parse_frontmatter(df).collect()}
    assert got == {"a": ("x\ty", []), "l": ("", ["one", 'two "b" \\ c']), "empty": ("[]", []), "z": ("plain", [])}
    assert DOC.parse_frontmatter(df, max_lines=2).count() == 0


def test_write_scopes_are_split_off(spark):
    df = spark.createDataFrame([(["User.Read", "Mail.Send", "https://graph.microsoft.com/Calendars.ReadWrite"],)], "s array<string>")
    r = df.select(O.read_only_split(F.col("s")).alias("r")).first()["r"]
    assert r["kept"] == ["User.Read"] and len(r["discarded"]) == 2


def test_meeting_notes_and_profiles(spark):
    from comms_lake.operators import meetings as MT
    c = spark.createDataFrame([(0, "e1", dt.datetime(2024, 3, 1, 9), "m1", None), (0, "e2", dt.datetime(2024, 3, 1, 8), "m1", None),
                               (1, "e3", dt.datetime(2024, 3, 1, 10), "m1", None), (1, "e4", dt.datetime(2024, 3, 1, 11), None, "late"),
                               (1, "e5", dt.datetime(2024, 3, 1, 7), "m2", "early"), (1, "e6", dt.datetime(2024, 3, 1, 7), None, None)],
                              "profile bigint, id string, start_ts timestamp_ntz, meeting_id string, motive string")
    assert {(r.profile, r.id) for r in MT.first_event_per_meeting(c).collect()} == {(0, "e2"), (1, "e3")}
    notes = {r.profile: r.note for r in MT.meeting_notes(c).collect()}
    assert notes == {0: "", 1: "sin acceso: early; 1 sin datos de Teams"}
    t = spark.createDataFrame([("m1", "t1", None)], "meeting_id string, transcript_id string, created timestamp_ntz")
    seen = spark.createDataFrame([(0, "t1")], "profile bigint, transcript_id string")
    left = MT.new_transcripts(MT.first_event_per_meeting(c), t, seen, F.lit(dt.datetime(2024, 2, 1)))
    assert [(r.profile, r.transcript_id) for r in left.collect()] == [(1, "t1")]   # each profile has its own index


def test_meeting_paths_chain(spark):
    from comms_lake.operators import documents as DOC
    rows = spark.createDataFrame([(f"t{i}", dt.datetime(2024, 3, 1, 9, i), "Sync") for i in range(3)] + [("t0", dt.datetime(2024, 3, 1, 9, 5), "Sync"),
                                  ("t0", dt.datetime(2024, 3, 1, 9, 6), "Sync")], "transcript_id string, started timestamp_ntz, subject string")
    paths = sorted(r.path for r in DOC.meeting_paths(rows, F.lit("acme")).collect())
    assert len(set(paths)) == 5 and sum(p.endswith("-2.md") for p in paths) == 1 and "reuniones/acme/2024-03-01-sync.md" in paths


def test_a_long_scope_folder_is_shortened_to_fit(spark):
    import datetime as dt
    import hashlib

    from comms_lake.operators import digest as D
    scope = "-".join(f"carpeta{k}" for k in range(12))
    rows = [(s, dt.date(2024, 3, 1), 1, dt.datetime(2024, 3, 1, 9), "m1", "a", ["b"], [], "s", "t", []) for s in (scope, "corta")]
    items = spark.createDataFrame(rows, "scope string, target_date date, days int, received timestamp_ntz, id string, sender string, "
                                  "to array<string>, cc array<string>, subject string, body_text string, categories array<string>")
    root = "/vault/" + "x" * 120
    got = {r.scope: r.path for r in D.mail_digest(items, [], "I", root=root).collect()}
    slug = D.X.slug_plain  # the folder's whole name
    whole = {r.scope: r.s for r in items.select("scope", slug("scope").alias("s")).collect()}[scope]
    folder = got[scope].split("/")[-2]
    assert len(f"{root}/{got[scope]}") <= 240 < len(f"{root}/{D.OUTPUT_DIR}/Mail/{whole}/2024-03-01.md")
    assert folder.endswith("-" + hashlib.sha1(whole.encode()).hexdigest()[:8]) and whole.startswith(folder[:-9])
    assert got["corta"].split("/")[-2] == "corta" and {r.path for r in D.mail_digest(items, [], "I").collect()} >= {got["corta"]}
