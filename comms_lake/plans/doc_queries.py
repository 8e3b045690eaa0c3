"""Named document and digest queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import digest as D
from ..operators import documents as DOC
from ..operators import mail as M
from ..session import run_dir
from ..sources.landed import append_documents, read_payloads, write_digests
from ..sources.testdata import TestViews, sql_with
from . import mail_queries as MQ
from . import sqlfn as Q
from .text_queries import _slug_tail, _yaml_quote_sql

INGESTED_AT = "2024-02-01T00:00:00+00:00"


def _sha(c):
    return F.sha1(c)  # of the text's UTF-8 bytes, which is how it is kept


def _rendered(v: TestViews):
    return DOC.render_mail(DOC.with_body_text(v.doc_messages))


def q_mail_documents(spark, sf_dir):
    r = _rendered(TestViews(spark, sf_dir))
    p = M.collision_paths(r, F.col("empresa"))
    return p.select("id", "path", F.octet_length("content").cast("bigint").alias("n_bytes"),
                    _sha(F.col("content")).alias("sha1"))


def q_frontmatter_roundtrip(spark, sf_dir):
    r = _rendered(TestViews(spark, sf_dir))
    return DOC.parse_frontmatter(r.select("id", "content")).select(
        "id", "key", "value", F.array_join("items", "|").alias("items"))


def q_dry_run_plan(spark, sf_dir):
    """K8: the paths a run would write (mail documents of the run's written
    rows), computed without touching any sink."""
    _, _, run = MQ.mail_run(TestViews(spark, sf_dir))
    w = run.filter(F.col("processed") & (F.col("outcome") == "written"))
    empresa = F.concat(F.lit("acme-"), F.col("profile").cast("string"))
    return M.collision_paths(w, empresa).select("profile", "id", F.lit("correo").alias("what"), "path")


def _digest_items(v: TestViews):
    m = M.first_occurrence(v.messages)
    u = F.col("user_id")

    def lab(x):
        return F.concat(F.lit("Usuario "), x.cast("string"), F.lit(" <u"), x.cast("string"), F.lit("@example.com>"))
    items = m.select(
        "profile", F.col("folder_id").alias("scope"), F.to_date("received").alias("target_date"), F.lit(1).alias("days"),
        "received", "id", lab(u).alias("sender"), F.array(lab(u + 1)).alias("to"),
        F.when(F.col("event_id") % 2 == 0, F.array(lab(u + 7))).otherwise(F.array().cast("array<string>")).alias("cc"),
        "subject", F.concat(F.lit("Mensaje "), F.col("event_id").cast("string"), F.lit(": k="), F.col("k").cast("string"))
        .alias("body_text"),
        F.when(F.col("event_id") % 3 == 0, F.array(F.lit("Rojo"))).otherwise(F.array().cast("array<string>")).alias("categories"))
    return items


def q_digest_mail(spark, sf_dir):
    d = D.mail_digest(_digest_items(TestViews(spark, sf_dir)), ["profile"], INGESTED_AT)
    return d.select("profile", "path", F.col("message_count").cast("bigint"), _sha(F.col("content")).alias("sha1"))


def q_digest_sink(spark, sf_dir):
    """K9: a first run stores the mail digests of half of the messages, a
    second those of all: one digest a kind, scope and date stays."""
    items = _digest_items(TestViews(spark, sf_dir))
    store = run_dir(spark, "digests") + "/store"
    for part in (items.filter(F.crc32("id") % 2 == 0), items):
        d = D.mail_digest(part, ["profile"], INGESTED_AT)
        stored = write_digests(d.select(F.lit("mail").alias("kind"), "target_date", F.concat_ws(
            "/", F.col("profile").cast("string"), "path").alias("path"), "content"), store)
    return stored.select("kind", "target_date", "path", _sha(F.col("content")).alias("sha1"))


def q_payload_quarantine(spark, sf_dir):
    e = TestViews(spark, sf_dir).events
    eid = F.col("event_id")
    kind = (F.when(F.col("event_type") == "click", F.lit("mail")).when(F.col("event_type") == "view", F.lit("calendar"))
            .when(F.col("event_type") == "purchase", F.lit("meetings")).when(F.col("event_type") == "signup", F.lit(None))
            .otherwise(F.lit("digest")))
    target = (F.when(eid % 7 == 1, F.date_format("ts", "yyyy-M-d")).when(eid % 7 == 2, F.lit("2024-02-30"))
              .otherwise(F.date_format("ts", "yyyy-MM-dd")))
    p = e.select("event_id", kind.alias("kind"), target.alias("target_date"),
                 (eid % 11 != 0).alias("has_vault_root"), (eid % 4 != 0).alias("has_folder_or_query"))
    return D.validate_payloads(p).select("event_id", "kind_effective", "error_code")


def _addr_txt(name, address):
    """``name <email>`` when both, else whichever is present."""
    n, a = F.coalesce(name, F.lit("")), F.coalesce(address, F.lit(""))
    return F.when((n != "") & (a != ""), F.concat(n, F.lit(" <"), a, F.lit(">"))).when(n != "", n).otherwise(a)


def _digest_ranges(v: TestViews, teams_only: bool = False):
    """Events with the target days that show them (F6 digest window: the
    day's midnight to 23:59:59), projected to digest rows (F14)."""
    from ..operators import calendar as C
    ev = v.timed.unionByName(v.spans)
    if teams_only:
        ev = ev.filter(C.is_teams(F.col("join_url"), F.col("is_online"), F.col("provider")))
    # midnight after start - 86399 s and before the end
    after = F.date_add(F.to_date(F.col("start_ts") - F.make_dt_interval(secs=F.lit(86399))), 1)
    before = F.to_date(F.coalesce("end_ts", "start_ts") - F.expr("INTERVAL 1 MICROSECOND"))
    d = C.event_day_bounds(ev).withColumns({"first_day": F.greatest("first_day", after), "last_day": F.least("last_day", before)})
    return d.filter("first_day <= last_day").withColumns({
        "organizer_txt": _addr_txt(F.col("org_name"), F.col("org_address")),
        "attendees_txt": F.filter(F.transform("attendees", lambda a: _addr_txt(a["emailAddress"]["name"],
                                                                               a["emailAddress"]["address"])),
                                  lambda x: x != ""),
        "body_text": F.lit(""), "days": F.lit(1)})


def _digest_events(v: TestViews, teams_only: bool = False):
    """One row per event and target day."""
    return _digest_ranges(v, teams_only).withColumn(
        "target_date", F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))))


def q_digest_calendar(spark, sf_dir):
    d = D.calendar_digest(_digest_ranges(TestViews(spark, sf_dir)), ["calendar", "profile"], INGESTED_AT)
    return d.select("calendar", "profile", "path", F.col("event_count").cast("bigint"), _sha(F.col("content")).alias("sha1"))


def q_digest_meetings(spark, sf_dir):
    """A12 + J9 + W10: Teams meetings of each day with their transcripts;
    a meeting without Teams data stays, with zero transcripts."""
    from ..operators import meetings as MT
    v = TestViews(spark, sf_dir)
    m = MT.with_meeting_id(_digest_events(v, teams_only=True), v.online_meetings)
    ts = (v.transcripts.groupBy("meeting_id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("created").alias("created"), F.col("transcript_id").alias("transcript_id"), F.col("vtt").alias("vtt"))))
        .alias("__t"))
        .select("meeting_id", F.transform("__t", lambda x: F.struct(x["transcript_id"].alias("transcript_id"),
                                                                    x["created"].alias("created"),
                                                                    x["vtt"].alias("vtt"))).alias("transcripts")))
    d = D.meetings_digest(m.join(ts, "meeting_id", "left"), ["calendar", "profile"], INGESTED_AT)
    return d.select("calendar", "profile", "path", F.col("meeting_count").cast("bigint"), "transcript_count",
                    _sha(F.col("content")).alias("sha1"))


def q_document_sink(spark, sf_dir):
    """K1: rendered message documents appended to the document store twice;
    the second append adds nothing (ids already stored)."""
    r = _rendered(TestViews(spark, sf_dir))
    p = M.collision_paths(r, F.col("empresa")).select(
        "id", "path", "content", "empresa", F.date_format("received", "yyyy-MM-dd").alias("fecha_dia"))
    store = run_dir(spark, "docs") + "/store"
    append_documents(p, store)
    stored = append_documents(p, store)
    return stored.select("id", "path", F.octet_length("content").cast("bigint").alias("n_bytes"),
                         F.sha1(F.encode("content", "UTF-8")).alias("sha1"))


def q_path_plan_existing(spark, sf_dir):
    """A first run wrote the documents of even event ids; the next run
    re-reads everything and plans against the stored files."""
    v = TestViews(spark, sf_dir)
    firsts = M.first_occurrence(v.messages)
    empresa = F.concat(F.lit("acme-"), F.col("profile").cast("string"))
    stored = M.collision_paths(firsts.filter(F.col("event_id") % 2 == 0), empresa).select("id", "path")
    return M.plan_against_existing(firsts, stored, empresa)


PAYLOAD = ("kind string, vault_root string, folder_or_query string, target_date string, days int, "
           "messages array<struct<id:string, internal_date:string, subject:string>>")


def q_payload_scan(spark, sf_dir):
    """S9 + F12 + F14: mail digest payloads land as JSON lines (every third
    with a byte-order mark, every fifth without ``kind``) and are read back,
    validated and counted."""
    items = _digest_items(TestViews(spark, sf_dir))
    g = items.groupBy("profile", "scope", "target_date").agg(
        F.array_sort(F.collect_list(F.struct(F.col("id"), F.date_format("received", "yyyy-MM-dd'T'HH:mm:ss'Z'")
                                             .alias("internal_date"), F.col("subject")))).alias("messages"),
        F.min("id").alias("first_id"))
    h = F.abs(F.hash("first_id"))
    payload = F.to_json(F.struct(
        F.when(h % 5 == 0, F.lit(None)).otherwise(F.lit("mail")).alias("kind"),
        F.concat(F.lit("/vaults/"), F.col("profile").cast("string")).alias("vault_root"),
        F.col("scope").alias("folder_or_query"), F.date_format("target_date", "yyyy-MM-dd").alias("target_date"),
        F.lit(1).alias("days"), F.col("messages")))
    line = F.when(h % 3 == 0, F.concat(F.lit("\ufeff"), payload)).otherwise(payload)
    path = run_dir(spark, "payloads")
    g.select(line.alias("value")).write.mode("overwrite").text(path)
    p = read_payloads(spark, path, PAYLOAD).withColumns({
        "has_vault_root": F.col("vault_root").isNotNull(), "has_folder_or_query": F.col("folder_or_query").isNotNull()})
    v = D.validate_payloads(p)
    return v.select(F.col("vault_root"), "folder_or_query", "target_date", "kind_effective", "error_code",
                    F.size("messages").cast("bigint").alias("n_messages"))


QUERIES = {
    "payload_scan": q_payload_scan,
    "path_plan_existing": q_path_plan_existing,
    "document_sink": q_document_sink,
    "digest_calendar": q_digest_calendar,
    "digest_meetings": q_digest_meetings,
    "mail_documents": q_mail_documents,
    "frontmatter_roundtrip": q_frontmatter_roundtrip,
    "dry_run_plan": q_dry_run_plan,
    "digest_mail": q_digest_mail,
    "digest_sink": q_digest_sink,
    "payload_quarantine": q_payload_quarantine,
}

# ---------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------
NL = "chr(10)"
WS_NO_NL = X.WHITESPACE_CLASS.replace(r"\n", "")


def _yaml_list_sql(key: str, lst: str) -> str:
    vals = f"list_filter({lst}, lambda v: coalesce(v, '') <> '')"
    return (f"(CASE WHEN len({vals}) = 0 THEN '{key}: []' ELSE '{key}:' || {NL} || "
            f"array_to_string(list_transform({vals}, lambda v: '  - ' || {_yaml_quote_sql('v')}), {NL}) END)")


def _label(name: str, addr: str) -> str:
    return Q.person_label(name, addr)


_people = Q.unique_people(
    f"[CASE WHEN {_label('from_name', 'from_address')} <> '' THEN {_label('from_name', 'from_address')} "
    f"ELSE {_label('sender_name', 'sender_address')} END] || "
    f"list_transform(to_list, lambda t: {_label('t.name', 't.address')}) || "
    f"list_transform(cc_list, lambda c: {_label('c.name', 'c.address')})", "q")
_names = (f"list_transform(attachments, lambda a: CASE WHEN {Q.one_line('a.name')} = '' THEN '(sin nombre)' "
          f"ELSE {Q.one_line('a.name')} END)")
_att_lines = (f"array_to_string(list_transform(attachments, lambda a: '- ' || CASE WHEN {Q.one_line('a.name')} = '' "
              f"THEN '(sin nombre)' ELSE {Q.one_line('a.name')} END || ' (' || CASE WHEN {Q.one_line('a.content_type')} = '' "
              f"THEN 'tipo desconocido' ELSE {Q.one_line('a.content_type')} END || ', ' || CASE WHEN a.size IS NULL "
              f"THEN 'tamaño desconocido' ELSE CAST(greatest(1, CAST(round_even(a.size / 1024.0, 0) AS BIGINT)) AS VARCHAR) "
              f"|| ' KB' END || ')'), {NL})")
_doc_ctes = {
    "dm": f"""
        SELECT *, regexp_replace(regexp_replace(replace(replace(body_text, chr(13) || chr(10), {NL}), chr(13), {NL}),
                  '^\\n+|\\n+$', '', 'g'), '(?m)^{WS_NO_NL}*---{WS_NO_NL}*$', '\\\\---', 'g') AS body
        FROM v_docmail""",
}
_doc_ctes["rendered"] = f"""
    SELECT m.*, concat_ws({NL},
        '---', 'fuente: correo', 'empresa: ' || {_yaml_quote_sql('empresa')}, 'cuenta: ' || {_yaml_quote_sql('cuenta')},
        'fecha: ' || strftime(received, '%Y-%m-%dT%H:%M:%S') || '+00:00',
        'creationDate: ' || strftime(received, '%Y-%m-%d'),
        'id_origen: ' || {_yaml_quote_sql('m.id')}, 'id_internet: ' || {_yaml_quote_sql('internet_id')},
        {_yaml_list_sql('participantes', _people)},
        'asunto: ' || {_yaml_quote_sql('subject')}, 'proyecto:', 'carpeta: ' || {_yaml_quote_sql('carpeta')},
        'hilo: ' || {_yaml_quote_sql('conversation_id')}, {_yaml_list_sql('adjuntos', _names)},
        CASE WHEN attachments_error THEN 'adjuntos_error: true' END,
        'ingestado: ' || ingestado, '---', '',
        CASE WHEN len(attachments) > 0 THEN concat_ws({NL}, '## Adjuntos', '', {_att_lines}, '')
             WHEN attachments_error THEN concat_ws({NL}, '## Adjuntos', '', '- (no se pudo leer la lista de adjuntos)', '') END,
        '## Cuerpo', '', regexp_replace(coalesce(m.body, ''), '{X.WHITESPACE_CLASS}+$', '', 'g')) AS doc
    FROM dm m"""
_doc_deps = {"dm": ["v_docmail"], "rendered": ["dm"]}

_slug_sql = _slug_tail("regexp_replace(lower(regexp_replace(strip_accents(coalesce(subject, '')), '[^\\x00-\\x7f]', '', 'g')), "
                       "'[^a-z0-9]+', '-', 'g')", X.SLUG_FALLBACK, X.SLUG_MAX_CHARS)


def _paths_sql(src: str, empresa: str) -> str:
    return f"""
        SELECT *, dir || '/' || CASE WHEN arrival = 1 THEN stem WHEN h_rank = 1 THEN stem || '-' || h6
                                     ELSE stem || '-' || h6 || '-' || h_rank END || '.md' AS path
        FROM (SELECT *, CASE WHEN arrival > 1 THEN row_number() OVER (
                          PARTITION BY dir, lower(stem), h6, arrival > 1 ORDER BY received, id) END AS h_rank
              FROM (SELECT *, row_number() OVER (PARTITION BY dir, lower(stem) ORDER BY received, id) AS arrival,
                           left(sha1(id), 6) AS h6
                    FROM (SELECT *, 'correo/' || {empresa} || '/' || strftime(received, '%Y-%m-%d') AS dir,
                                 strftime(received, '%H%M') || '-' || {_slug_sql} AS stem FROM {src})))"""


def _cal_digest_sql(meetings: bool) -> str:
    from .calendar_queries import _cal_ctes
    addr = ("CASE WHEN coalesce({n}, '') <> '' AND coalesce({a}, '') <> '' THEN {n} || ' <' || {a} || '>' "
            "WHEN coalesce({n}, '') <> '' THEN {n} ELSE coalesce({a}, '') END")
    att = (f"list_filter(list_transform(attendees, lambda a: {addr.format(n='a.name', a='a.address')}), "
           "lambda x: x <> '')")
    cap = "array_to_string(l, ', ')"
    s, e = "coalesce(strftime(start_ts, '%Y-%m-%d %H:%M'), '')", "coalesce(strftime(end_ts, '%Y-%m-%d %H:%M'), '')"
    org = addr.format(n="org_name", a="org_address")
    teams = ("coalesce(join_url, '') <> '' AND (coalesce(is_online, false) OR lower(coalesce(provider, '')) = "
             "'teamsforbusiness' OR contains(join_url, 'teams.microsoft'))")
    head = [f"'## ' || {s} || ' ' || " + ("CASE WHEN coalesce(subject, '') = '' THEN '(no subject)' ELSE subject END"
                                          + ("" if meetings else " || CASE WHEN cancelled THEN ' (cancelled)' ELSE '' END")),
            "''", f"'- **Start:** ' || {s}", f"'- **End:** ' || {e}",
            f"'- **Organizer:** ' || CASE WHEN ({org}) = '' THEN '(unknown organizer)' ELSE {org} END",
            f"CASE WHEN len(l) > 0 THEN '- **Attendees:** ' || {cap} END"]
    if meetings:
        tblock = ("concat_ws(chr(10), '### Transcript ' || i || CASE WHEN t.created IS NOT NULL THEN ' (' || "
                  "strftime(t.created, '%Y-%m-%d %H:%M') || ')' ELSE '' END, '', CASE WHEN coalesce(t.tid, '') <> '' "
                  "THEN '- **Transcript ID:** `' || t.tid || '`' || chr(10) END, CASE WHEN trim(coalesce(t.vtt, '')) <> '' "
                  "THEN '```vtt' || chr(10) || replace(t.vtt, '```', '` ` `') || chr(10) || '```' "
                  "ELSE '_(transcript content unavailable)_' END, '')")
        rest = ["CASE WHEN coalesce(join_url, '') <> '' THEN '- **Teams join:** ' || join_url END",
                "CASE WHEN coalesce(id, '') <> '' THEN '- **Event ID:** `' || id || '`' END",
                "CASE WHEN coalesce(meeting_id, '') <> '' THEN '- **Online meeting ID:** `' || meeting_id || '`' END",
                "'- **Transcripts available:** ' || len(coalesce(ts, []))", "''",
                f"CASE WHEN len(coalesce(ts, [])) > 0 THEN array_to_string(list_transform(ts, lambda t, i: {tblock}), chr(10)) END"]
    else:
        rest = ["CASE WHEN coalesce(location, '') <> '' THEN '- **Location:** ' || location END",
                "CASE WHEN coalesce(join_url, '') <> '' THEN '- **Teams join:** ' || join_url END",
                "CASE WHEN coalesce(id, '') <> '' THEN '- **Event ID:** `' || id || '`' END",
                "''", "'### Body excerpt'", "''", "'_(body unavailable)_'", "''"]
    sec = "concat_ws(chr(10), " + ", ".join(head + rest) + ")"
    kind = "meetings" if meetings else "calendar"
    counts = ("'meeting_count: ' || n, 'transcript_count: ' || nt" if meetings else "'event_count: ' || n")
    title = ("'# Teams meetings + transcripts, ' || d || ' to ' || d" if meetings else "'# Outlook calendar, ' || d || ' to ' || d")
    note = ("'_Meetings in this digest: ' || n || ', transcripts: ' || nt || ' (whole, as WebVTT)._'" if meetings else
            "'_Events in this digest: ' || n || '._'")
    folder = "Meetings" if meetings else "Calendar"
    extra_cols = ", nt AS transcript_count" if meetings else ""
    count_name = "meeting_count" if meetings else "event_count"
    ctes = dict(_cal_ctes("g_"))
    deps = {"g_ev": ["v_timed", "v_spans"], "g_b": ["g_ev"], "g_days": ["g_b"]}
    ctes = {k: ctes[k] for k in ("g_ev", "g_b", "g_days")}
    filt = f"AND {teams}" if meetings else ""
    ctes["win"] = f"""
        SELECT * FROM g_days WHERE start_ts < CAST(day AS TIMESTAMP) + INTERVAL 86399 SECOND
          AND coalesce(end_ts, start_ts) > CAST(day AS TIMESTAMP) {filt}"""
    deps["win"] = ["g_days"]
    if meetings:
        ctes["res"] = "SELECT join_url, min(meeting_id) AS meeting_id FROM v_online GROUP BY join_url"
        ctes["tl"] = ("SELECT meeting_id, list(struct_pack(tid := transcript_id, created := created, vtt := vtt) "
                      "ORDER BY created, transcript_id) AS ts FROM v_transcripts GROUP BY meeting_id")
        ctes["rows"] = "SELECT w.*, r.meeting_id, tl.ts FROM win w LEFT JOIN res r USING (join_url) LEFT JOIN tl USING (meeting_id)"
        deps.update({"res": ["v_online"], "tl": ["v_transcripts"], "rows": ["win", "res", "tl"]})
        src_rows = "rows"
        ntexpr = "sum(len(coalesce(ts, [])))"
    else:
        src_rows = "win"
        ntexpr = "0"
    body = f"""
        SELECT calendar, profile, 'External Inputs/Outlook/{folder}/' || d || '.md' AS path, CAST(n AS BIGINT) AS {count_name}{extra_cols},
          sha1(concat_ws(chr(10), '---', 'type: external-input', 'source: outlook', 'kind: {kind}', 'date_range: ' || d || '..' || d,
               {counts}, 'ingested_at: {INGESTED_AT}', 'entity_ids:', '  outlook_event:', ids, '---', '', {title}, '', {note}, '')
               || regexp_replace(secs, '{X.WHITESPACE_CLASS}+$', '', 'g') || chr(10)) AS sha1
        FROM (SELECT calendar, profile, strftime(day, '%Y-%m-%d') AS d, count(*) AS n, CAST({ntexpr} AS BIGINT) AS nt,
                array_to_string(list('    - ' || id ORDER BY start_ts NULLS FIRST, id), chr(10)) AS ids,
                string_agg(sec, chr(10) ORDER BY start_ts NULLS FIRST, id) AS secs
              FROM (SELECT *, {sec} AS sec FROM (SELECT *, {att} AS l FROM {src_rows}))
              GROUP BY calendar, profile, day)"""
    return sql_with(body, extra=ctes, extra_deps=deps)


ORACLE = {
    "mail_documents": sql_with(f"""
        SELECT id, path, CAST(strlen(doc) AS BIGINT) AS n_bytes, sha1(doc) AS sha1
        FROM (SELECT *, regexp_replace(doc, '\\n+$', '', 'g') || {NL} AS doc2 FROM rendered) r
        JOIN ({_paths_sql('v_docmail', 'empresa')}) p USING (id)""".replace("sha1(doc) AS", "sha1(doc2) AS")
                               .replace("strlen(doc) AS", "strlen(doc2) AS"),
                               extra=_doc_ctes, extra_deps=_doc_deps),
    "frontmatter_roundtrip": sql_with(f"""
        SELECT id, key, value, items FROM (
          SELECT id, unnest([
            struct_pack(key := 'fuente', value := 'correo', items := ''),
            struct_pack(key := 'empresa', value := empresa, items := ''), struct_pack(key := 'cuenta', value := cuenta, items := ''),
            struct_pack(key := 'fecha', value := strftime(received, '%Y-%m-%dT%H:%M:%S') || '+00:00', items := ''),
            struct_pack(key := 'creationDate', value := strftime(received, '%Y-%m-%d'), items := ''),
            struct_pack(key := 'id_origen', value := id, items := ''), struct_pack(key := 'id_internet', value := internet_id, items := ''),
            struct_pack(key := 'participantes', value := '', items := array_to_string({_people}, '|')),
            struct_pack(key := 'asunto', value := coalesce(subject, ''), items := ''), struct_pack(key := 'proyecto', value := '', items := ''),
            struct_pack(key := 'carpeta', value := carpeta, items := ''), struct_pack(key := 'hilo', value := conversation_id, items := ''),
            struct_pack(key := 'adjuntos', value := CASE WHEN len(attachments) = 0 THEN '[]' ELSE '' END, items := array_to_string({_names}, '|')),
            struct_pack(key := 'ingestado', value := ingestado, items := '')]
            || CASE WHEN attachments_error THEN [struct_pack(key := 'adjuntos_error', value := 'true', items := '')] ELSE [] END) AS kv
          FROM v_docmail) x(id, kv)
        CROSS JOIN LATERAL (SELECT kv.key AS key, kv.value AS value, kv.items AS items)""", "v_docmail"),
    "dry_run_plan": MQ._mail_sql(f"""
        SELECT profile, id, 'correo' AS what, path
        FROM ({_paths_sql("(SELECT * FROM run WHERE processed AND outcome = 'written')", "'acme-' || profile")})"""),
    "payload_quarantine": """
        SELECT event_id, coalesce(nullif(kind, ''), 'mail') AS kind_effective,
          CASE WHEN NOT has_vault_root THEN 'missing_vault_root'
               WHEN try_strptime(target_date, '%Y-%m-%d') IS NULL
                    OR strftime(try_strptime(target_date, '%Y-%m-%d'), '%Y-%m-%d') <> target_date THEN 'bad_target_date'
               WHEN coalesce(nullif(kind, ''), 'mail') = 'mail' AND NOT has_folder_or_query THEN 'missing_folder_or_query'
               WHEN coalesce(nullif(kind, ''), 'mail') NOT IN ('mail', 'calendar', 'meetings') THEN 'unknown_kind'
               ELSE '' END AS error_code
        FROM (SELECT event_id,
                CASE event_type WHEN 'click' THEN 'mail' WHEN 'view' THEN 'calendar' WHEN 'purchase' THEN 'meetings'
                                WHEN 'signup' THEN NULL ELSE 'digest' END AS kind,
                CASE WHEN event_id % 7 = 1 THEN strftime(ts, '%Y-') || CAST(month(ts) AS VARCHAR) || '-' || CAST(day(ts) AS VARCHAR)
                     WHEN event_id % 7 = 2 THEN '2024-02-30' ELSE strftime(ts, '%Y-%m-%d') END AS target_date,
                event_id % 11 <> 0 AS has_vault_root, event_id % 4 <> 0 AS has_folder_or_query FROM events)""",
    "digest_mail": MQ._mail_sql(f"""
        SELECT profile, 'External Inputs/Outlook/Mail/' || slug || '/' || d || '.md' AS path,
          CAST(n AS BIGINT) AS message_count,
          sha1(concat_ws({NL}, '---', 'type: external-input', 'source: outlook', 'kind: mail',
            'folder_or_query: ' || esc, 'scope_kind: ' || kind, 'date_range: ' || d || '..' || d,
            'message_count: ' || n, 'ingested_at: {INGESTED_AT}', 'entity_ids:', '  outlook:', ids, '---', '',
            '# Outlook mail ' || kind || ' ' || scope || ', ' || d || ' to ' || d, '',
            '_Messages in this digest: ' || n || '._',
            '') || body) AS sha1
        FROM (
          SELECT profile, scope, strftime(target_date, '%Y-%m-%d') AS d, count(*) AS n,
            {_slug_tail("regexp_replace(lower(scope), '[^a-z0-9]+', '-', 'g')", X.PLAIN_SLUG_FALLBACK, None)} AS slug,
            CASE WHEN regexp_matches(scope, '[":#\\n''\\[\\]{{}}]') THEN '"' || replace(replace(scope, '\\', '\\\\'), '"', '\\"') || '"'
                 ELSE scope END AS esc,
            CASE WHEN regexp_matches(scope, '["\\s]') OR regexp_matches(scope, '{D.QUERY_WORDS}') THEN 'query' ELSE 'folder' END AS kind,
            array_to_string(list('    - ' || id ORDER BY received, id), {NL}) AS ids,
            regexp_replace(string_agg(sec, {NL} ORDER BY received, id), '{X.WHITESPACE_CLASS}+$', '', 'g') || {NL} AS body
          FROM (
            SELECT *, concat_ws({NL}, '## ' || strftime(received, '%Y-%m-%d %H:%M') || ' ' || sender, '',
                '- **Subject:** ' || CASE WHEN coalesce(subject, '') = '' THEN '(no subject)' ELSE subject END,
                CASE WHEN to_s <> '' THEN '- **To:** ' || to_s END, CASE WHEN cc_s <> '' THEN '- **Cc:** ' || cc_s END,
                CASE WHEN cats <> '' THEN '- **Categories:** ' || cats END,
                '- **Outlook message ID:** `' || id || '`', '', '### Body excerpt', '', body_text,
                '') AS sec
            FROM (
                SELECT profile, folder_id AS scope, CAST(received AS DATE) AS target_date, received, id, subject,
                  'Usuario ' || user_id || ' <u' || user_id || '@example.com>' AS sender,
                  'Usuario ' || (user_id + 1) || ' <u' || (user_id + 1) || '@example.com>' AS to_s,
                  CASE WHEN event_id % 2 = 0 THEN 'Usuario ' || (user_id + 7) || ' <u' || (user_id + 7) || '@example.com>'
                       ELSE '' END AS cc_s,
                  CASE WHEN event_id % 3 = 0 THEN 'Rojo' ELSE '' END AS cats,
                  'Mensaje ' || event_id || ': k=' || k AS body_text
                FROM (SELECT * EXCLUDE (rn0) FROM (SELECT *, row_number() OVER (
                        PARTITION BY profile, id ORDER BY received, pos) AS rn0 FROM v_messages) WHERE rn0 = 1)))
          GROUP BY profile, scope, target_date)""", upto="marks"),
    "path_collisions": sql_with(f"""
        SELECT profile, id, path FROM ({_paths_sql(
            "(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY profile, id ORDER BY received, pos) AS rn "
            "FROM v_messages) WHERE rn = 1)", "'acme-' || profile")})""", "v_messages"),
    "digest_calendar": _cal_digest_sql(False),
    "digest_meetings": _cal_digest_sql(True),
}
ORACLE["document_sink"] = ORACLE["mail_documents"]
_FIRSTS = ("(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY profile, id ORDER BY received, pos) AS rn "
           "FROM v_messages) WHERE rn = 1)")
ORACLE["path_plan_existing"] = sql_with(f"""
    SELECT profile, id, dir || '/' || CASE WHEN arrival = 1 THEN stem WHEN h_rank = 1 THEN stem || '-' || h6
                                           ELSE stem || '-' || h6 || '-' || h_rank END || '.md' AS path, 'planned' AS status
    FROM f4
    UNION ALL
    SELECT f.profile, f.id, p1.path, 'already' FROM firsts f JOIN p1 USING (id)""", "v_messages", extra={
    "firsts": f"SELECT * FROM {_FIRSTS}",
    "p1": f"SELECT id, path FROM ({_paths_sql('(SELECT * FROM firsts WHERE event_id % 2 = 0)', "'acme-' || profile")})",
    "parts": """SELECT id AS ex_id, lower(path) AS ex_path, regexp_extract(lower(path), '^(.*)/[^/]*$', 1) AS dir_l,
                       regexp_extract(lower(path), '/([^/]*)\\.md$', 1) AS name FROM p1""",
    "bare": "SELECT DISTINCT dir_l, name AS stem_l FROM parts",
    "hashed": """SELECT dir_l, regexp_extract(name, '^(.*-[0-9a-f]{6})(-\\d+)?$', 1) AS h_l,
                        list(coalesce(try_cast(regexp_extract(name, '-[0-9a-f]{6}-(\\d+)$', 1) AS BIGINT), 1)) AS h_taken
                 FROM parts WHERE regexp_matches(name, '-[0-9a-f]{6}(-\\d+)?$') GROUP BY 1, 2""",
    "d": f"""SELECT *, 'correo/acme-' || profile || '/' || strftime(received, '%Y-%m-%d') AS dir,
                    strftime(received, '%H%M') || '-' || {_slug_sql} AS stem, left(sha1(id), 6) AS h6 FROM firsts""",
    "fresh": """SELECT d.*, b.stem_l IS NOT NULL AS bare_taken FROM d
                LEFT JOIN bare b ON lower(d.dir) = b.dir_l AND lower(d.stem) = b.stem_l
                WHERE d.id NOT IN (SELECT ex_id FROM parts)""",
    "f2": """SELECT *, row_number() OVER (PARTITION BY dir, lower(stem) ORDER BY received, id)
                    + CASE WHEN bare_taken THEN 1 ELSE 0 END AS arrival FROM fresh""",
    "f3": """SELECT f2.*, coalesce(h.h_taken, []) AS h_taken FROM f2
             LEFT JOIN hashed h ON lower(f2.dir) = h.dir_l AND lower(f2.stem || '-' || f2.h6) = h.h_l""",
    "f4": """SELECT *, CASE WHEN arrival > 1 THEN list_filter(range(1, nth + len(h_taken) + 1),
                    lambda x: NOT list_contains(h_taken, x))[nth] END AS h_rank
             FROM (SELECT *, row_number() OVER (PARTITION BY dir, lower(stem), h6, arrival > 1 ORDER BY received, id) AS nth
                   FROM f3)""",
}, extra_deps={"firsts": ["v_messages"], "p1": ["firsts"], "parts": ["p1"], "bare": ["parts"], "hashed": ["parts"],
               "d": ["firsts"], "fresh": ["d", "bare", "parts"], "f2": ["fresh"], "f3": ["f2", "hashed"], "f4": ["f3"]})
ORACLE["payload_scan"] = MQ._mail_sql("""
    SELECT '/vaults/' || profile AS vault_root, folder_id AS folder_or_query, strftime(CAST(received AS DATE), '%Y-%m-%d') AS target_date,
           'mail' AS kind_effective, '' AS error_code, CAST(count(*) AS BIGINT) AS n_messages
    FROM (SELECT * EXCLUDE (rn0) FROM (SELECT *, row_number() OVER (PARTITION BY profile, id ORDER BY received, pos) AS rn0
                FROM v_messages) WHERE rn0 = 1)
    GROUP BY profile, folder_id, CAST(received AS DATE)""", upto="marks")
ORACLE["digest_sink"] = ORACLE["digest_mail"].replace(
    "SELECT profile, 'External Inputs/Outlook/Mail/' || slug || '/' || d || '.md' AS path,\n          CAST(n AS BIGINT) AS message_count,",
    "SELECT 'mail' AS kind, d AS target_date, profile || '/External Inputs/Outlook/Mail/' || slug || '/' || d || '.md' AS path,")
