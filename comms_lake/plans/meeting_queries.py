"""Named meeting / transcript queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vtt as V
from ..operators import calendar as C
from ..operators import documents as DOC
from ..operators import meetings as MT
from ..session import run_dir, with_params
from ..sources.landed import append_documents
from ..sources.testdata import MEETINGS_LOOKBACK_DAYS, TestViews, sql_with
from . import sqlfn as Q


def _window(v: TestViews):
    r = v.run_at.select(
        (F.date_trunc("day", "run_at").cast("timestamp_ntz")
         - F.make_dt_interval(days=F.lit(MEETINGS_LOOKBACK_DAYS))).alias("window_start"),
        F.col("run_at").alias("now"))
    return r


def _candidates(v: TestViews):
    return MT.candidates(with_params(v.timed, _window(v)), F.col("window_start"), F.col("now"))


def _resolved(v: TestViews):
    return MT.with_refusals(MT.with_meeting_id(_candidates(v), v.online_meetings), v.refusals)


def q_meeting_candidates(spark, sf_dir):
    c = _candidates(TestViews(spark, sf_dir))
    return c.select("profile", "id", "join_url")


def q_meeting_transcripts(spark, sf_dir):
    v = TestViews(spark, sf_dir)
    firsts = MT.first_event_per_meeting(_resolved(v))
    t = MT.new_transcripts(firsts, v.transcripts, v.seen_transcripts, F.col("window_start"))
    return t.select("profile", "id", "meeting_id", "transcript_id")


def q_unmatched_meetings(spark, sf_dir):
    v = TestViews(spark, sf_dir)
    return MT.meeting_notes(_resolved(v))


def q_cue_table(spark, sf_dir):
    v = TestViews(spark, sf_dir)
    cues = V.vtt_cues(v.transcripts, "vtt", F.col("attributed"))
    return cues.select("transcript_id", F.col("block_pos").cast("bigint"), F.col("voice_pos").cast("bigint"),
                       "start", "speaker", "text")


def q_cue_roundtrip(spark, sf_dir):
    v = TestViews(spark, sf_dir)
    cues = V.vtt_cues(v.transcripts, "vtt", F.col("attributed"))
    parsed = cues.select(F.col("transcript_id"), (F.col("block_pos") - 1).alias("pos"),
                         V.cue_line(F.col("start"), F.col("speaker"), F.col("text")).alias("line"))
    c = v.cues.join(v.transcripts.select(F.concat(F.lit("t"), F.col("meeting_id").substr(3, 20)).alias("transcript_id"),
                                         F.col("meeting_id").substr(3, 20).cast("bigint").alias("meeting"),
                                         "attributed"), "meeting")
    secs = F.col("pos") * 7
    start = F.concat_ws(":", *[F.lpad(x.cast("string"), 2, "0") for x in
                               ((secs / 3600).cast("int"), (secs / 60).cast("int") % 60, secs % 60)])
    name = (F.when(~F.col("attributed"), F.lit("Desconocido"))
            .when(F.col("speaker") == "user", F.lit("Ana Pérez"))
            .when(F.col("speaker") == "assistant", F.lit("Asistente Virtual")).otherwise(F.lit("Desconocido")))
    expected = c.select("transcript_id", "pos", V.cue_line(start, name, X.one_line("text")).alias("expected"))
    j = expected.join(parsed, ["transcript_id", "pos"], "full")
    return j.groupBy("transcript_id").agg(
        F.count("expected").alias("n_turns"), F.count("line").alias("n_lines"),
        F.count_if(F.col("line") == F.col("expected")).alias("n_match"))


INGESTADO = "2024-02-01T00:00:00+00:00"


def _documents(v: TestViews):
    """K3 + W10: one document per profile and new transcript (first event per
    meeting), its cue lines in order, and the VTT sidecar's path."""
    firsts = MT.first_event_per_meeting(_resolved(v))
    t = MT.new_transcripts(C.with_people(firsts), v.transcripts, v.seen_transcripts, F.col("window_start"))
    t = t.withColumns({"started": F.coalesce("created", "start_ts"),
                       "empresa": F.concat(F.lit("acme-"), F.col("profile").cast("string")),
                       "cuenta": F.concat(F.lit("u"), F.col("profile").cast("string"), F.lit("@example.com"))})
    t = DOC.meeting_paths(t, F.col("empresa"))
    cues = V.vtt_cues(v.transcripts.join(t.select("transcript_id"), "transcript_id", "left_semi"), "vtt",
                      F.col("attributed"))
    lines = cues.select("transcript_id", "block_pos", "voice_pos",
                        V.cue_line(F.col("start"), F.col("speaker"), F.col("text")).alias("line"))
    return DOC.render_meeting(t, lines, INGESTADO)


def q_meeting_documents(spark, sf_dir):
    return _documents(TestViews(spark, sf_dir)).select(
        "profile", "transcript_id", "path", F.octet_length("content").cast("bigint").alias("n_bytes"),
        F.sha1(F.encode("content", "UTF-8")).alias("sha1"))


def q_transcript_sink(spark, sf_dir):
    """K3: documents and their verbatim VTT sidecars, stored twice (the second
    append adds nothing) and read back."""
    docs = _documents(TestViews(spark, sf_dir)).select(
        F.concat_ws("/", F.col("profile").cast("string"), "transcript_id").alias("id"), "path", "content", "vtt_path", "vtt",
        "empresa", F.date_format("started", "yyyy-MM-dd").alias("fecha_dia"))
    store = run_dir(spark, "transcripts") + "/store"
    append_documents(docs, store)
    stored = append_documents(docs, store)
    return stored.select("id", "path", "vtt_path", F.sha1(F.encode("content", "UTF-8")).alias("sha1"),
                         F.sha1(F.encode("vtt", "UTF-8")).alias("vtt_sha1"))


QUERIES = {
    "meeting_documents": q_meeting_documents,
    "transcript_sink": q_transcript_sink,
    "meeting_candidates": q_meeting_candidates,
    "meeting_transcripts": q_meeting_transcripts,
    "unmatched_meetings": q_unmatched_meetings,
    "cue_table": q_cue_table,
    "cue_roundtrip": q_cue_roundtrip,
}

# ---------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------
_M_CTES = {
    "win": f"""SELECT date_trunc('day', run_at) - INTERVAL {MEETINGS_LOOKBACK_DAYS} DAY AS window_start,
                      run_at AS now FROM v_run""",
    "cands": """
        SELECT t.*, w.window_start FROM v_timed t CROSS JOIN win w
        WHERE coalesce(join_url, '') <> '' AND (coalesce(is_online, false) OR lower(coalesce(provider, '')) = 'teamsforbusiness'
              OR contains(join_url, 'teams.microsoft'))
          AND NOT coalesce(cancelled, false) AND start_ts IS NOT NULL AND start_ts >= w.window_start
          AND coalesce(end_ts, start_ts) <= w.now""",
    "resolved": "SELECT join_url, min(meeting_id) AS meeting_id FROM v_online GROUP BY join_url",
    "withid": """SELECT c.*, r.meeting_id, x.motive FROM cands c LEFT JOIN resolved r USING (join_url)
                 LEFT JOIN v_refusals x USING (join_url)""",
}
_M_DEPS = {"win": ["v_run"], "cands": ["v_timed", "win"], "resolved": ["v_online"],
           "withid": ["cands", "resolved", "v_refusals"]}

_WS = Q.WS


def _cue_start_sql(stamp: str) -> str:
    parts = f"string_split(split_part(replace({stamp}, ',', '.'), '.', 1), ':')"

    def two(x: str) -> str:
        return f"lpad(CAST(CAST({x} AS INTEGER) AS VARCHAR), 2, '0')"
    hh = "CASE WHEN len(p) >= 3 THEN p[len(p) - 2] ELSE '0' END"
    return (f"(SELECT {two(hh)} || ':' || {two('p[len(p) - 1]')} || ':' || {two('p[len(p)]')} "
            f"FROM (SELECT {parts} AS p))")


_CUE_CTES = {
    "blocks": f"""
        SELECT transcript_id, attributed, b.bpos AS block_pos, string_split(b.block, chr(10)) AS lines
        FROM (SELECT *, unnest(list_transform(string_split_regex(regexp_replace(replace(replace(vtt, chr(13) || chr(10), chr(10)),
                 chr(13), chr(10)), '^\\x{{feff}}+', ''), '\\n{_WS}*\\n'),
                 lambda x, i: struct_pack(block := x, bpos := i - 1))) AS b FROM v_transcripts)""",
    "timed_blocks": f"""
        SELECT * FROM (
          SELECT transcript_id, attributed, block_pos, lines,
            list_position(list_transform(lines, lambda l: contains(l, ' --> ') AND contains(split_part(l, ' --> ', 1), ':')
              AND translate(trim(split_part(l, ' --> ', 1)), '0123456789:.,', '') = ''), true) AS idx FROM blocks)
        WHERE idx IS NOT NULL""",
    "payloads": f"""
        SELECT transcript_id, attributed, block_pos,
          trim(split_part(lines[idx], ' --> ', 1)) AS stamp,
          trim(array_to_string(list_slice(lines, idx + 1, len(lines)), ' ')) AS payload
        FROM timed_blocks""",
    # the payload in pieces: what stands before the first tag, then tag and text; a voice tag opens a span, its end tag closes it
    "pieces": """
        SELECT transcript_id, attributed, block_pos, stamp, i, CASE WHEN i > 1 THEN split_part(p, '>', 1) ELSE '' END AS tag,
          CASE WHEN i > 1 THEN substr(p, length(split_part(p, '>', 1)) + 2) ELSE p END AS txt
        FROM (SELECT * EXCLUDE payload, unnest(string_split(payload, '<')) AS p, generate_subscripts(string_split(payload, '<'), 1) AS i
              FROM payloads WHERE payload <> '')""",
    "opened": """
        SELECT *, count(*) FILTER (WHERE tag = 'v' OR tag LIKE 'v.%' OR tag LIKE 'v %') OVER w AS span,
          count(*) FILTER (WHERE tag = '/v') OVER w AS ended, max(tag = 'v' OR tag LIKE 'v.%' OR tag LIKE 'v %')
            OVER (PARTITION BY transcript_id, block_pos) AS voiced
        FROM pieces WINDOW w AS (PARTITION BY transcript_id, block_pos ORDER BY i)""",
    "voices": """
        SELECT transcript_id, attributed, block_pos, stamp, greatest(span, 1) AS vp,
          CASE WHEN voiced THEN any_value(substr(tag, length(split_part(tag, ' ', 1)) + 1) ORDER BY i) END AS spk,
          string_agg(txt, '' ORDER BY i) AS txt
        FROM (SELECT *, min(ended) OVER (PARTITION BY transcript_id, block_pos, span) AS before FROM opened)
        WHERE NOT voiced OR (span > 0 AND ended = before)
        GROUP BY transcript_id, attributed, block_pos, stamp, voiced, greatest(span, 1)""",
    "cues": f"""
        SELECT transcript_id, CAST(block_pos AS BIGINT) AS block_pos, CAST(vp - 1 AS BIGINT) AS voice_pos,
          {_cue_start_sql('stamp')} AS start,
          CASE WHEN attributed AND {Q.normalize_name("coalesce(spk, '')")} <> ''
               THEN {Q.normalize_name("coalesce(spk, '')")} ELSE 'Desconocido' END AS speaker,
          {Q.one_line("txt")} AS text
        FROM voices""",
}
_CUE_DEPS = {"blocks": ["v_transcripts"], "timed_blocks": ["blocks"], "payloads": ["timed_blocks"],
             "pieces": ["payloads"], "opened": ["pieces"], "voices": ["opened"], "cues": ["voices"]}


def _msql(body: str, ctes: dict[str, str], deps: dict[str, list[str]]) -> str:
    return sql_with(body, extra=ctes, extra_deps=deps)


def _yq(x: str) -> str:
    from .text_queries import _yaml_quote_sql
    return _yaml_quote_sql(x)


def _yl(key: str, lst: str) -> str:
    from .doc_queries import _yaml_list_sql
    return _yaml_list_sql(key, lst)


def _slug_meeting() -> str:
    from .text_queries import _slug_tail
    return _slug_tail("regexp_replace(lower(regexp_replace(strip_accents(coalesce(subject, '')), '[^\\x00-\\x7f]', '', 'g')), "
                      "'[^a-z0-9]+', '-', 'g')", "reunion", 60)


ORACLE = {
    "meeting_candidates": _msql("SELECT profile, id, join_url FROM cands", _M_CTES, _M_DEPS),
    "meeting_transcripts": _msql("""
        SELECT profile, id, meeting_id, transcript_id FROM (
          SELECT *, row_number() OVER (PARTITION BY profile, meeting_id ORDER BY start_ts, id) AS rn
          FROM withid WHERE meeting_id IS NOT NULL AND motive IS NULL) f
        JOIN v_transcripts t USING (meeting_id)
        WHERE rn = 1 AND (profile, transcript_id) NOT IN (SELECT (profile, transcript_id) FROM v_seen_transcripts)
          AND (t.created IS NULL OR t.created >= f.window_start)""",
                                 {**_M_CTES, "x": "SELECT 1"},
                                 {**_M_DEPS, "x": ["withid", "v_transcripts", "v_seen_transcripts"]}),
    "unmatched_meetings": _msql("""
        SELECT profile, count(*) AS candidates, count(*) FILTER (WHERE meeting_id IS NULL AND motive IS NULL) AS unmatched,
          concat_ws('; ', 'sin acceso: ' || arg_min(motive, struct_pack(s := start_ts, i := id)) FILTER (WHERE motive IS NOT NULL),
                    CASE WHEN count(*) FILTER (WHERE meeting_id IS NULL AND motive IS NULL) > 0 THEN
                      count(*) FILTER (WHERE meeting_id IS NULL AND motive IS NULL) || ' sin datos de Teams' END) AS note
        FROM withid GROUP BY profile""", _M_CTES, _M_DEPS),
    "cue_table": _msql("SELECT * FROM cues WHERE text <> ''", _CUE_CTES, _CUE_DEPS),
    "cue_roundtrip": _msql(f"""
        SELECT coalesce(e.transcript_id, p.transcript_id) AS transcript_id, count(e.expected) AS n_turns,
               count(p.line) AS n_lines, count(*) FILTER (WHERE p.line = e.expected) AS n_match
        FROM (SELECT 't' || c.meeting AS transcript_id, c.pos,
                '[' || lpad(CAST(c.pos * 7 // 3600 AS VARCHAR), 2, '0') || ':'
                    || lpad(CAST((c.pos * 7 // 60) % 60 AS VARCHAR), 2, '0') || ':'
                    || lpad(CAST(c.pos * 7 % 60 AS VARCHAR), 2, '0') || '] '
                || CASE WHEN NOT t.attributed THEN 'Desconocido' WHEN c.speaker = 'user' THEN 'Ana Pérez'
                        WHEN c.speaker = 'assistant' THEN 'Asistente Virtual' ELSE 'Desconocido' END
                || ': ' || {Q.one_line('c.text')} AS expected
              FROM v_cues c JOIN v_transcripts t ON t.meeting_id = 'om' || c.meeting) e
        FULL JOIN (SELECT transcript_id, block_pos - 1 AS pos, '[' || start || '] ' || speaker || ': ' || text AS line
                   FROM cues) p ON e.transcript_id = p.transcript_id AND e.pos = p.pos
        GROUP BY coalesce(e.transcript_id, p.transcript_id)""", _CUE_CTES, _CUE_DEPS),
    "meeting_documents": _msql(f"""
        SELECT profile, transcript_id, dir || '/' || nm || '.md' AS path, CAST(strlen(doc) AS BIGINT) AS n_bytes, sha1(doc) AS sha1
        FROM (SELECT p.*, regexp_replace(concat_ws(chr(10), '---', 'fuente: reunion',
                'empresa: "acme-' || profile || '"', 'cuenta: "u' || profile || '@example.com"',
                'fecha: ' || strftime(started, '%Y-%m-%dT%H:%M:%S') || '+00:00',
                'creationDate: ' || strftime(started, '%Y-%m-%d'), 'id_origen: "' || transcript_id || '"',
                {_yl('participantes', Q.event_people('org_name', 'org_address', 'attendees'))},
                'asunto: ' || {_yq('subject')}, 'proyecto:',
                'organizador: ' || {_yq(Q.person_label('org_name', 'org_address'))},
                'vtt: ' || {_yq("nm || '.vtt'")},
                CASE WHEN NOT attributed THEN 'hablantes: sin-atribucion' END,
                'ingestado: {INGESTADO}', '---', '', '## Transcripción', '',
                CASE WHEN coalesce(l.body, '') = '' THEN '(transcripción vacía)' ELSE l.body END), '\\n+$', '', 'g')
                || chr(10) AS doc
              FROM paths p LEFT JOIN lines l USING (transcript_id))""",
                                {**_M_CTES, **_CUE_CTES, **{
        "firsts": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY profile, meeting_id ORDER BY start_ts, id) AS rn
                     FROM withid WHERE meeting_id IS NOT NULL AND motive IS NULL) WHERE rn = 1""",
        "nt": """SELECT f.*, t.transcript_id, t.created, t.attributed, t.vtt, coalesce(t.created, f.start_ts) AS started
                 FROM firsts f JOIN v_transcripts t USING (meeting_id)
                 WHERE (f.profile, t.transcript_id) NOT IN (SELECT (profile, transcript_id) FROM v_seen_transcripts)
                   AND (t.created IS NULL OR t.created >= f.window_start)""",
        "paths": f"""SELECT *, CASE WHEN arrival = 1 THEN stem WHEN later = 1 THEN stem || '-' || h6
                                     ELSE stem || '-' || h6 || '-' || later END AS nm
                 FROM (SELECT *, left(sha1(transcript_id), 6) AS h6, CASE WHEN arrival > 1 THEN row_number() OVER (
                         PARTITION BY dir, lower(stem), left(sha1(transcript_id), 6), arrival > 1 ORDER BY started, transcript_id) END AS later
                 FROM (SELECT *, row_number() OVER (PARTITION BY dir, lower(stem) ORDER BY started, transcript_id) AS arrival
                       FROM (SELECT *, 'reuniones/acme-' || profile AS dir,
                                    strftime(started, '%Y-%m-%d') || '-' || {_slug_meeting()} AS stem FROM nt)))""",
        "lines": """SELECT transcript_id, string_agg('[' || start || '] ' || speaker || ': ' || text, chr(10)
                                                 ORDER BY block_pos, voice_pos) AS body
                    FROM cues WHERE text <> '' GROUP BY transcript_id"""}},
                                {**_M_DEPS, **_CUE_DEPS, "firsts": ["withid"],
                                 "nt": ["firsts", "v_transcripts", "v_seen_transcripts"], "paths": ["nt"],
                                 "lines": ["cues"]}),
}

ORACLE["transcript_sink"] = ORACLE["meeting_documents"].replace(
    "SELECT profile, transcript_id, dir || '/' || nm || '.md' AS path, CAST(strlen(doc) AS BIGINT) AS n_bytes, sha1(doc) AS sha1",
    "SELECT profile || '/' || transcript_id AS id, dir || '/' || nm || '.md' AS path, dir || '/' || nm || '.vtt' AS vtt_path, "
    "sha1(doc) AS sha1, sha1(vtt) AS vtt_sha1")
