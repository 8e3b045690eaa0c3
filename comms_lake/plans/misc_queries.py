"""Named queries for scans, scopes, settings and labels (S3, F4, F6, F13,
J16, X14, X25)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calendar as C
from ..operators import mail as M
from ..operators import ops as O
from ..session import bounded, materialize
from ..sources.testdata import TestViews, sql_with

PAST_DAYS, AHEAD_DAYS = 1, 14
SCOPE_FOLDER = "Compras"


def q_calendar_window(spark, sf_dir):
    """S3 + F6: each calendar's view window (local midnight of its latest
    event day minus 1 day, to midnight after +14 days), overlap filter."""
    v = TestViews(spark, sf_dir)
    ev = v.timed.unionByName(v.spans)
    today = ev.groupBy("calendar").agg(F.to_date(F.max("start_ts")).alias("today"))
    w = today.select("calendar",
                     F.date_sub("today", PAST_DAYS).cast("timestamp_ntz").alias("win_start"),
                     F.date_add("today", AHEAD_DAYS + 1).cast("timestamp_ntz").alias("win_end"))
    inwin = C.window_overlap(ev.join(bounded(materialize(w, "windows")), "calendar"), F.col("win_start"), F.col("win_end"))
    return inwin.select("calendar", "profile", "id")


def q_folder_scope(spark, sf_dir):
    """F4 + L6: the folder whose display name matches exactly (first id),
    then the scope's messages."""
    v = TestViews(spark, sf_dir)
    fid = (v.tree.filter(F.col("display_name") == SCOPE_FOLDER)
           .agg(F.min("folder_id").alias("folder_id")))
    return M.first_occurrence(v.messages).join(fid, "folder_id", "left_semi").select("profile", "id", "folder_id")


def q_empresa_check(spark, sf_dir):
    c = TestViews(spark, sf_dir).table("customer")
    k = F.col("c_custkey")
    emp = (F.when(k % 13 == 0, F.lit("x" * 33)).when(k % 11 == 0, F.lit("")).when(k % 7 == 0, F.lit("con"))
           .when(k % 5 == 0, F.col("c_mktsegment")).otherwise(F.lower("c_mktsegment")))
    return c.select("c_custkey", emp.alias("empresa"), O.valid_slug_key(emp).alias("valid"))


def q_settings_join(spark, sf_dir):
    """Rows to their profile settings (equi-join on profile; both sides
    are one row a profile by then)."""
    v = TestViews(spark, sf_dir)
    p = F.col("user_id").cast("string")
    s = v.events.select("user_id").distinct().select(
        F.col("user_id").alias("profile"), F.concat(F.lit("perfil-"), p).alias("slug"), F.concat(F.lit("acme-"), p).alias("empresa"),
        (F.lit(500) + F.col("user_id") % 3 * 500).alias("max_messages_per_run"), (F.col("user_id") % 2 == 0).alias("teams"))
    n = v.messages.groupBy("profile").agg(F.count("*").alias("messages"))
    return n.join(s, "profile").select("profile", "slug", "empresa", "max_messages_per_run", "teams", "messages")


def q_graph_time_hint(spark, sf_dir):
    e = TestViews(spark, sf_dir).events
    eid = F.col("event_id")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("0"),
                    F.when(eid % 5 == 0, F.lit("Z")).otherwise(F.lit("")))
    zone = (F.when(eid % 4 == 0, F.lit("UTC")).when(eid % 4 == 1, F.lit("")).when(eid % 4 == 2, F.lit("Pacific Standard Time"))
            .otherwise(F.lit("utc")))
    return e.select("event_id", O.graph_time_hint(text, zone).alias("value"))


def q_error_labels(spark, sf_dir):
    e = TestViews(spark, sf_dir).events
    k = F.col("k")
    kind = (F.when(F.col("event_type").isin("error", "click"), F.lit("graph")).when(F.col("event_type") == "view", F.lit("network"))
            .when(F.col("event_type") == "signup", F.lit("os")).otherwise(F.lit("other")))
    status = F.when(k % 3 == 0, F.lit(403)).when(k % 3 == 1, F.lit(404)).otherwise(F.lit(429))
    code = F.when(k % 4 == 0, F.lit("Forbidden")).when(k % 4 == 1, F.lit("GraphAccessToTranscriptsDisabled")).otherwise(F.lit(""))
    inner = F.when(k % 5 == 0, F.lit("ErrorAccessDenied")).otherwise(F.lit(""))
    msg = F.when(k % 7 == 0, F.lit("tenant: SpeakerAttributionNotAllowed")).otherwise(F.lit("x"))
    exc = F.when(F.col("event_type") == "view", F.lit("TimeoutError")).when(F.col("event_type") == "signup", F.lit("PermissionError")) \
        .otherwise(F.lit("ValueError"))
    return e.select("event_id", O.error_label(kind, status, code, inner, msg, exc).alias("label"))


QUERIES = {
    "calendar_window": q_calendar_window,
    "folder_scope": q_folder_scope,
    "empresa_check": q_empresa_check,
    "settings_join": q_settings_join,
    "graph_time_hint": q_graph_time_hint,
    "error_labels": q_error_labels,
}

_reserved = ", ".join(f"'{n}'" for n in __import__("comms_lake.functions.text", fromlist=["x"]).RESERVED_NAMES)

ORACLE = {
    "calendar_window": sql_with(f"""
        SELECT e.calendar, e.profile, e.id
        FROM (SELECT * FROM v_timed UNION ALL BY NAME SELECT * FROM v_spans) e
        JOIN (SELECT calendar, CAST(CAST(max(start_ts) AS DATE) - {PAST_DAYS} AS TIMESTAMP) AS win_start,
                     CAST(CAST(max(start_ts) AS DATE) + {AHEAD_DAYS + 1} AS TIMESTAMP) AS win_end
              FROM (SELECT * FROM v_timed UNION ALL BY NAME SELECT * FROM v_spans) GROUP BY calendar) w USING (calendar)
        WHERE e.start_ts < w.win_end AND coalesce(e.end_ts, e.start_ts) > w.win_start""", "v_timed", "v_spans"),
    "folder_scope": sql_with(f"""
        SELECT profile, id, folder_id FROM (
          SELECT *, row_number() OVER (PARTITION BY profile, id ORDER BY received, pos) AS rn FROM v_messages)
        WHERE rn = 1 AND folder_id = (SELECT min(folder_id) FROM v_tree WHERE display_name = '{SCOPE_FOLDER}')""",
                             "v_messages", "v_tree"),
    "empresa_check": f"""
        SELECT c_custkey, empresa, regexp_full_match(trim(empresa), '[a-z0-9-]{{1,32}}') AND trim(empresa) NOT IN ({_reserved}) AS valid
        FROM (SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN '{"x" * 33}' WHEN c_custkey % 11 = 0 THEN ''
                                     WHEN c_custkey % 7 = 0 THEN 'con' WHEN c_custkey % 5 = 0 THEN c_mktsegment
                                     ELSE lower(c_mktsegment) END AS empresa FROM customer)""",
    "settings_join": sql_with("""
        SELECT profile, 'perfil-' || profile AS slug, 'acme-' || profile AS empresa, 500 + profile % 3 * 500 AS max_messages_per_run,
               profile % 2 = 0 AS teams, count(*) AS messages
        FROM v_messages GROUP BY profile""", "v_messages"),
    "graph_time_hint": """
        SELECT event_id, CASE WHEN zone IN ('', 'utc') AND NOT regexp_matches(t, '([zZ]|[+-]\\d{2}:?\\d{2})$')
                              THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' ELSE t END AS value
        FROM (SELECT event_id, ts, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '0' || CASE WHEN event_id % 5 = 0 THEN 'Z' ELSE '' END AS t,
                     lower(CASE event_id % 4 WHEN 0 THEN 'UTC' WHEN 1 THEN '' WHEN 2 THEN 'Pacific Standard Time' ELSE 'utc' END) AS zone
              FROM events)""",
    "error_labels": """
        SELECT event_id,
          CASE WHEN kind = 'graph' THEN 'Graph ' || CASE
                 WHEN inner_code = 'GraphAccessToTranscriptsDisabled' OR code = 'GraphAccessToTranscriptsDisabled'
                      OR contains(msg, 'GraphAccessToTranscriptsDisabled') THEN status || ' GraphAccessToTranscriptsDisabled'
                 WHEN inner_code = 'SpeakerAttributionNotAllowed' OR code = 'SpeakerAttributionNotAllowed'
                      OR contains(msg, 'SpeakerAttributionNotAllowed') THEN status || ' SpeakerAttributionNotAllowed'
                 ELSE trim(status || ' ' || CASE WHEN inner_code <> '' THEN inner_code ELSE code END) END
               WHEN kind = 'network' THEN 'red (' || exc || ')' WHEN kind = 'os' THEN 'disco (' || exc || ')' ELSE exc END AS label
        FROM (SELECT event_id,
                CASE WHEN event_type IN ('error', 'click') THEN 'graph' WHEN event_type = 'view' THEN 'network'
                     WHEN event_type = 'signup' THEN 'os' ELSE 'other' END AS kind,
                CAST(CASE WHEN k % 3 = 0 THEN 403 WHEN k % 3 = 1 THEN 404 ELSE 429 END AS VARCHAR) AS status,
                CASE WHEN k % 4 = 0 THEN 'Forbidden' WHEN k % 4 = 1 THEN 'GraphAccessToTranscriptsDisabled' ELSE '' END AS code,
                CASE WHEN k % 5 = 0 THEN 'ErrorAccessDenied' ELSE '' END AS inner_code,
                CASE WHEN k % 7 = 0 THEN 'tenant: SpeakerAttributionNotAllowed' ELSE 'x' END AS msg,
                CASE WHEN event_type = 'view' THEN 'TimeoutError' WHEN event_type = 'signup' THEN 'PermissionError'
                     ELSE 'ValueError' END AS exc
              FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events))""",
}
