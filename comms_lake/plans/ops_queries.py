"""Named operations queries (S1, S8, S10, S11, K6, A7, A8, A13, A15-A17, U3,
X24, X33). Landed files are written by Spark from the given tables into the
shared checkpoint folder and read back through the source readers."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..operators import ops as O
from ..operators.ordered import prefix_sums
from ..session import run_dir
from ..sources import landed as L
from ..sources.testdata import TestViews, sql_with

PAGE_SIZE = 50


def _runs(v: TestViews):
    e = v.events
    eid = F.col("event_id")
    return e.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("when"),
        F.concat(F.lit("perfil-"), (F.col("user_id") % 5).cast("string")).alias("perfil"),
        (F.floor("value").cast("bigint") % 50).alias("correo_nuevos"), F.lit(16).alias("calendario_dias"),
        (eid % 4).alias("reuniones"),
        F.when(eid % 9 == 0, F.lit("2 sin datos de Teams")).otherwise(F.lit("")).alias("reuniones_nota"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("error: "), (eid % 3 + 1).cast("string"),
                                                         F.lit(" correos sin escribir"))).otherwise(F.lit("ok")).alias("estado"),
        F.when(eid % 13 == 0, F.array(F.lit("tope de 1000 mensajes alcanzado, continúa en la siguiente")))
        .otherwise(F.array().cast("array<string>")).alias("notas"))


def q_run_summary(spark, sf_dir):
    v = TestViews(spark, sf_dir)
    path = run_dir(spark, "runlog")
    runs = _runs(v)
    for half in (runs.filter(F.col("reuniones") < 2), runs.filter(F.col("reuniones") >= 2)):   # K6: each run appends
        L.append_run_log(half, path)
    return O.run_rollup(L.read_run_log(spark, path))                                            # S11 + A7/A8


def q_audit_by_action(spark, sf_dir):
    e = TestViews(spark, sf_dir).events
    line = F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("ts"), F.col("event_type").alias("action"),
        F.when(F.col("event_type") == "error", F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        F.lit("0.6.0").alias("version"), F.create_map(F.lit("k"), F.col("k").cast("string")).alias("summary"),
        F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("result_id")))
    broken = F.col("event_id") % 50 == 0
    path = run_dir(spark, "audit")
    e.select(F.when(broken, F.left(line, F.char_length(line) - 5)).otherwise(line).alias("value")) \
        .write.mode("overwrite").text(path)
    return O.audit_counts(L.read_json_log(spark, path))


def paged(rows, item):
    """Each profile's rows, in time order, as paged envelopes (``PAGE_SIZE``
    items and a link to the next page)."""
    pos = prefix_sums(rows.withColumn("scan", F.col("profile").cast("string")), ["scan"], ["ts", "event_id"],
                      F.date_trunc("day", "ts"), {"n": F.lit(1)})
    pages = pos.withColumn("page", F.expr(f"(n - 1) div {PAGE_SIZE}"))
    last = pages.groupBy("scan").agg(F.max("page").alias("last_page"))
    return (pages.groupBy("scan", "page").agg(F.array_sort(F.collect_list(F.struct("n", item.alias("it")))).alias("__v"))
             .join(last, "scan")
             .select("scan", "page", F.transform("__v", lambda x: x["it"]).alias("value"),
                     F.when(F.col("page") < F.col("last_page"),
                            F.concat(F.lit("https://service.example/next?page="), (F.col("page") + 1).cast("string")))
                     .alias("@odata.nextLink")))


def _land_pages(spark, rows, item, name):
    """Land paged envelopes as JSON lines."""
    path = run_dir(spark, name)
    paged(rows, item).write.mode("overwrite").json(path)
    return path


def q_capped_scans(spark, sf_dir):
    """S1 + A15: events land as paged envelopes and are counted per scan."""
    e = TestViews(spark, sf_dir).events.withColumn("profile", F.col("user_id"))
    item = F.struct(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"),
                    F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS0").alias("dateTime"),
                             F.lit("UTC").alias("timeZone")).alias("start"))
    got = L.read_pages(spark, _land_pages(spark, e, item, "pages"), L.EVENT)
    return L.scan_caps(got).select("scan", "pages_read", "items_read", "capped")


def _entry(name, address):
    return F.struct(F.struct(name.alias("name"), address.alias("address")).alias("emailAddress"))


def q_landed_messages(spark, sf_dir):
    """S1 + S2 + X10 + F9: messages land as objects in paged envelopes; they
    are read back, concatenated and flattened. Some have no time, no id, an
    address in ``sender`` only, or an HTML body."""
    e = TestViews(spark, sf_dir).events.withColumn("profile", F.col("user_id"))
    eid, u = F.col("event_id"), F.col("user_id").cast("string")
    address = F.concat(F.lit("u"), u, F.lit("@example.com"))
    html = eid % 4 == 0
    item = F.struct(
        F.when(eid % 29 == 0, F.lit("")).otherwise(F.concat(F.lit("m"), eid.cast("string"))).alias("id"),
        F.concat(F.lit("<"), eid.cast("string"), F.lit("@mail.example>")).alias("internetMessageId"),
        F.col("event_type").alias("parentFolderId"), F.concat(F.col("event_type"), F.lit(" "), u).alias("subject"),
        F.when(eid % 31 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("receivedDateTime"),
        _entry(F.concat(F.lit("Usuario "), u), F.when(eid % 6 == 0, F.lit("")).otherwise(address)).alias("from"),
        _entry(F.lit(""), address).alias("sender"),
        F.array(_entry(F.lit("Lista"), F.lit("lista@example.com")), _entry(F.lit(""), F.lit(""))).alias("toRecipients"),
        F.struct(F.when(html, F.lit("HTML")).otherwise(F.lit("text")).alias("contentType"),
                 F.when(eid % 9 == 0, F.lit("")).otherwise(F.concat(F.lit("<p>"), eid.cast("string"), F.lit("</p>")))
                 .alias("content")).alias("body"),
        F.when(eid % 8 == 0, F.lit("")).otherwise(F.concat(F.lit("vista "), eid.cast("string"))).alias("bodyPreview"))
    got = L.flatten_messages(L.page_items(L.read_pages(spark, _land_pages(spark, e, item, "mail-pages"), L.MESSAGE)))
    return got.select("scan", "id", "internet_id", "folder_id", "subject", "sender",
                      F.date_format("received", "yyyy-MM-dd HH:mm:ss").alias("received"),
                      F.array_join("to", "; ").alias("to"), "body_text")


def q_landed_events(spark, sf_dir):
    """S1 + S3 + F14 + X14: calendar objects land as paged envelopes and are
    flattened to digest rows; naive UTC times become unambiguous."""
    e = TestViews(spark, sf_dir).events.withColumn("profile", F.col("user_id"))
    eid, u = F.col("event_id"), F.col("user_id").cast("string")
    stamp = lambda t: F.struct(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS0").alias("dateTime"),
                               F.when(eid % 5 == 0, F.lit("Pacific Standard Time")).otherwise(F.lit("UTC")).alias("timeZone"))
    item = F.struct(
        F.concat(F.lit("e"), eid.cast("string")).alias("id"), F.col("event_type").alias("subject"),
        stamp(F.col("ts")).alias("start"), stamp(F.col("ts") + F.make_dt_interval(mins=F.lit(30))).alias("end"),
        _entry(F.concat(F.lit("Usuario "), u), F.lit("")).alias("organizer"),
        F.struct(F.when(eid % 3 == 0, F.lit("Sala 1")).alias("displayName")).alias("location"),
        F.when(eid % 7 == 0, F.lit(True)).alias("isCancelled"),
        F.struct(F.when(eid % 2 == 0, F.concat(F.lit("https://meet.example/"), eid.cast("string"))).alias("joinUrl"))
        .alias("onlineMeeting"),
        F.struct(F.lit("text").alias("contentType"), F.concat(F.lit("nota "), eid.cast("string")).alias("content")).alias("body"))
    got = L.flatten_events(L.page_items(L.read_pages(spark, _land_pages(spark, e, item, "event-pages"), L.EVENT)))
    return got.select("scan", "id", "subject", "start", "end", "timezone", "organizer", "location", "join_url", "cancelled",
                      "body_text")


def q_config_conflicts(spark, sf_dir):
    c = TestViews(spark, sf_dir).table("customer")
    key = F.col("c_custkey")
    lock = (F.when(key % 97 == 0, F.concat(F.lit("locks/"), (key % 3).cast("string")))
            .when(key % 2 == 0, F.lit("Locks/Main/")).otherwise(F.lit("locks\\main")))
    prof = c.select(F.concat(F.lit("vault-"), F.col("c_nationkey").cast("string")).alias("vault"), lock.alias("lock_path"))
    return O.lock_conflicts(prof)


def q_check_scorecard(spark, sf_dir):
    e = TestViews(spark, sf_dir).events
    status = (F.when(F.col("event_type") == "error", F.lit("FAIL")).when(F.col("event_type") == "signup", F.lit("WARN"))
              .otherwise(F.lit("PASS")))
    return O.scorecard(e.select(F.col("user_id").alias("profile"), status.alias("status")), ["profile"])


_GRANTED = ["https://graph.microsoft.com/User.Read", "mail.read", " Mail.Send ", "Calendars.ReadWrite",
            "HTTPS://GRAPH.MICROSOFT.COM/Calendars.Read.Shared", "OnlineMeetings.Read",
            "OnlineMeetingTranscript.Read.All", "openid"]


def _grants(v: TestViews):
    users = v.events.select("user_id").distinct()
    arr = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(s).alias("scope")) for i, s in enumerate(_GRANTED)])
    g = users.select("user_id", F.inline(arr))
    keep = ((F.col("user_id") % 4 != 1) | (F.col("i") != F.col("user_id") % 7)) & (F.col("user_id") % 10 != 0)
    # users with user_id % 10 = 0 hold a legacy token without a scope list
    return g.select("user_id", F.when(keep, F.col("scope")).alias("scope"))


def q_scope_drift(spark, sf_dir):
    return O.scope_check(_grants(TestViews(spark, sf_dir)), O.CORPORATE_SCOPES)


def q_scope_split(spark, sf_dir):
    """U3 + X24: what a read-only run keeps and discards of each user's granted scopes."""
    g = _grants(TestViews(spark, sf_dir)).groupBy("user_id").agg(F.array_sort(F.collect_list("scope")).alias("scopes"))
    split = O.read_only_split(F.col("scopes"))
    return g.select("user_id", F.array_join(split["kept"], ",").alias("kept"), F.array_join(split["discarded"], ",").alias("discarded"))


def _logs(v: TestViews):
    e = v.events
    codes = F.array(*[F.lit(c) for c, _ in O.AADSTS_CATALOGUE])
    i = (F.col("k") % 16).cast("int")
    body = (F.when(i < len(O.AADSTS_CATALOGUE), F.concat(F.lit("HTTP 400 "), F.element_at(codes, i + 1), F.lit(": trace "),
                                                          F.col("event_id").cast("string")))
            .when(i == 14, F.lit("HTTP 400 AADSTS5001131: unknown variant")).otherwise(F.lit("timeout")))
    return e.select(F.col("event_id").alias("log_id"), body.alias("body"))


def q_error_triage(spark, sf_dir):
    return O.error_triage(_logs(TestViews(spark, sf_dir)))


def q_calendar_list(spark, sf_dir):
    s = TestViews(spark, sf_dir).table("supplier")
    k = F.col("s_suppkey")
    cals = s.select(F.concat(F.lit("cal"), k.cast("string")).alias("id"), F.col("s_name").alias("name"),
                    F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("s"), k.cast("string"), F.lit("@example.com")))
                    .alias("owner_address"),
                    F.when(k % 5 == 0, F.lit(None)).otherwise(k % 2 == 0).alias("can_edit"))
    return O.calendar_kinds(cals).select("id", "name", "kind")


def q_index_scan(spark, sf_dir):
    """S13 + K4 + K7: the id index as an append-only text file (blank lines
    and repeated appends included) and the tab-separated skip list, read
    back as tables."""
    v = TestViews(spark, sf_dir)
    root = run_dir(spark, "index")
    v.index_ids.select(F.explode(F.array(F.col("id"), F.lit(""), F.concat(F.lit("  "), F.col("id")))).alias("value")) \
        .write.mode("overwrite").text(os.path.join(root, "ids"))
    v.skipped.select(F.concat_ws("\t", F.col("id"), F.lit("2024-02-01T00:00:00+00:00"), F.lit("write failed 3 times"))
                     .alias("value")).write.mode("overwrite").text(os.path.join(root, "skipped"))
    idx = L.read_index(spark, os.path.join(root, "ids")).select("id", F.lit("index").alias("source"))
    sk = L.read_skip_list(spark, os.path.join(root, "skipped")).select("id", F.lit("skip").alias("source"))
    return idx.unionByName(sk)


QUERIES = {
    "index_scan": q_index_scan,
    "run_summary": q_run_summary,
    "audit_by_action": q_audit_by_action,
    "capped_scans": q_capped_scans,
    "landed_messages": q_landed_messages,
    "landed_events": q_landed_events,
    "config_conflicts": q_config_conflicts,
    "check_scorecard": q_check_scorecard,
    "scope_drift": q_scope_drift,
    "scope_split": q_scope_split,
    "error_triage": q_error_triage,
    "calendar_list": q_calendar_list,
}

_cat_list = "[" + ", ".join(f"'{c}'" for c, _ in O.AADSTS_CATALOGUE) + "]"
_cat_rows = ", ".join(f"({i}, '{c}', '{m.replace(chr(39), chr(39) * 2)}')" for i, (c, m) in enumerate(O.AADSTS_CATALOGUE))
_granted_list = "[" + ", ".join(f"'{s}'" for s in _GRANTED) + "]"
_required_rows = ", ".join(f"({i}, '{s}')" for i, s in enumerate(O.CORPORATE_SCOPES))

ORACLE = {
    "index_scan": sql_with("SELECT DISTINCT id, 'index' AS source FROM v_index UNION ALL SELECT id, 'skip' FROM v_skip",
                           "v_index", "v_skip"),
    "run_summary": """
        SELECT 'perfil-' || (user_id % 5) AS perfil, count(*) AS runs,
               sum(CAST(floor(value) AS BIGINT) % 50) AS correo_nuevos, sum(16) AS calendario_dias, sum(event_id % 4) AS reuniones,
               count(*) FILTER (WHERE event_id % 13 = 0) AS con_notas,
               count(*) FILTER (WHERE event_type = 'error') AS con_error,
               max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS exit_code
        FROM events GROUP BY 1""",
    "audit_by_action": """
        SELECT CASE WHEN event_id % 50 = 0 THEN '(corrupt)' ELSE event_type END AS action, count(*) AS n
        FROM events GROUP BY 1""",
    "capped_scans": f"""
        SELECT CAST(user_id AS VARCHAR) AS scan, CAST(ceil(count(*) / {PAGE_SIZE}) AS BIGINT) AS pages_read,
               count(*) AS items_read, false AS capped
        FROM events GROUP BY 1""",
    "landed_messages": """
        SELECT CAST(user_id AS VARCHAR) AS scan, CASE WHEN event_id % 29 = 0 THEN '' ELSE 'm' || event_id END AS id,
          '<' || event_id || '@mail.example>' AS internet_id, event_type AS folder_id, event_type || ' ' || user_id AS subject,
          CASE WHEN event_id % 6 = 0 THEN 'Usuario ' || user_id ELSE 'Usuario ' || user_id || ' <u' || user_id || '@example.com>' END AS sender,
          CASE WHEN event_id % 31 <> 0 THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS received,
          'Lista <lista@example.com>' AS "to",
          CASE WHEN event_id % 4 = 0 THEN (CASE WHEN event_id % 8 <> 0 THEN 'vista ' || event_id
                                                WHEN event_id % 9 = 0 THEN '' ELSE '<p>' || event_id || '</p>' END)
               WHEN event_id % 9 <> 0 THEN '<p>' || event_id || '</p>'
               WHEN event_id % 8 = 0 THEN '' ELSE 'vista ' || event_id END AS body_text
        FROM events""",
    "landed_events": """
        SELECT CAST(user_id AS VARCHAR) AS scan, 'e' || event_id AS id, event_type AS subject,
          CASE WHEN event_id % 5 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '0'
               ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' END AS start,
          CASE WHEN event_id % 5 = 0 THEN strftime(ts + INTERVAL 30 MINUTE, '%Y-%m-%dT%H:%M:%S.%f') || '0'
               ELSE strftime(ts + INTERVAL 30 MINUTE, '%Y-%m-%dT%H:%M:%S') || 'Z' END AS "end",
          CASE WHEN event_id % 5 = 0 THEN 'Pacific Standard Time' ELSE 'UTC' END AS timezone,
          'Usuario ' || user_id AS organizer, CASE WHEN event_id % 3 = 0 THEN 'Sala 1' ELSE '' END AS location,
          CASE WHEN event_id % 2 = 0 THEN 'https://meet.example/' || event_id ELSE '' END AS join_url,
          event_id % 7 = 0 AS cancelled, 'nota ' || event_id AS body_text
        FROM events""",
    "config_conflicts": """
        SELECT vault, count(DISTINCT lower(regexp_replace(replace(trim(lock_path), '\\', '/'), '^/+|/+$', '', 'g'))) AS n_lock_paths,
               count(*) AS n_profiles
        FROM (SELECT 'vault-' || c_nationkey AS vault,
                CASE WHEN c_custkey % 97 = 0 THEN 'locks/' || (c_custkey % 3) WHEN c_custkey % 2 = 0 THEN 'Locks/Main/'
                     ELSE 'locks\\main' END AS lock_path FROM customer)
        GROUP BY vault HAVING count(DISTINCT lower(regexp_replace(replace(trim(lock_path), '\\', '/'), '^/+|/+$', '', 'g'))) > 1""",
    "check_scorecard": f"""
        SELECT user_id AS profile, count(*) FILTER (WHERE event_type NOT IN ('error', 'signup')) AS passed,
               count(*) FILTER (WHERE event_type = 'signup') AS warned, count(*) FILTER (WHERE event_type = 'error') AS failed
        FROM events GROUP BY 1""",
    "scope_drift": f"""
        WITH users AS (SELECT DISTINCT user_id FROM events),
        g AS (SELECT user_id, CASE WHEN ((user_id % 4 <> 1) OR (i - 1 <> user_id % 7)) AND user_id % 10 <> 0 THEN s END AS scope
              FROM (SELECT user_id, unnest({_granted_list}) AS s, unnest(range(1, {len(_GRANTED) + 1})) AS i FROM users)),
        gn AS (SELECT DISTINCT user_id, lower(trim(CASE WHEN lower(trim(scope)) LIKE 'https://graph.microsoft.com/%'
                                     THEN substr(trim(scope), 29) ELSE trim(scope) END)) AS norm FROM g WHERE scope IS NOT NULL),
        req AS (SELECT * FROM (VALUES {_required_rows}) r(pos, scope)
                WHERE lower(scope) NOT IN ('offline_access', 'openid', 'profile', 'email')),
        cnt AS (SELECT user_id, count(scope) AS n FROM g GROUP BY user_id),
        miss AS (SELECT c.user_id, r.pos, r.scope FROM cnt c, req r
                 WHERE c.n > 0 AND NOT EXISTS (SELECT 1 FROM gn WHERE gn.user_id = c.user_id AND gn.norm = lower(r.scope)))
        SELECT c.user_id, coalesce(m.s, '') = '' AS ok, coalesce(m.s, '') AS missing
        FROM cnt c LEFT JOIN (SELECT user_id, string_agg(scope, ',' ORDER BY pos) AS s FROM miss GROUP BY user_id) m USING (user_id)""",
    "scope_split": f"""
        WITH users AS (SELECT DISTINCT user_id FROM events),
        g AS (SELECT user_id, CASE WHEN ((user_id % 4 <> 1) OR (i - 1 <> user_id % 7)) AND user_id % 10 <> 0 THEN s END AS scope
              FROM (SELECT user_id, unnest({_granted_list}) AS s, unnest(range(1, {len(_GRANTED) + 1})) AS i FROM users)),
        w AS (SELECT *, contains(lower(scope), 'readwrite') OR contains(lower(scope), '.send') AS writes FROM g)
        SELECT user_id, coalesce(string_agg(scope, ',' ORDER BY scope) FILTER (WHERE NOT writes), '') AS kept,
               coalesce(string_agg(scope, ',' ORDER BY scope) FILTER (WHERE writes), '') AS discarded
        FROM w GROUP BY user_id""",
    "error_triage": f"""
        WITH logs AS (
          SELECT event_id AS log_id,
            CASE WHEN k % 16 < 14 THEN 'HTTP 400 ' || {_cat_list}[CAST(k % 16 AS INTEGER) + 1] || ': trace ' || event_id
                 WHEN k % 16 = 14 THEN 'HTTP 400 AADSTS5001131: unknown variant' ELSE 'timeout' END AS body
          FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)),
        cat AS (SELECT * FROM (VALUES {_cat_rows}) c(pos, code, meaning))
        SELECT l.log_id, arg_min(c.code, c.pos) AS code, arg_min(c.meaning, c.pos) AS meaning
        FROM logs l LEFT JOIN cat c ON contains(l.body, c.code) GROUP BY l.log_id""",
    "calendar_list": """
        SELECT 'cal' || s_suppkey AS id, s_name AS name,
               CASE WHEN s_suppkey % 3 <> 0 AND NOT coalesce(CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_suppkey % 2 = 0 END, true)
                    THEN 'shared' ELSE 'own' END AS kind
        FROM supplier""",
}
