"""Named mail queries over the test views, with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import mail as M
from ..sources.testdata import BACKFILL_DAYS, EXCLUDE_FOLDERS, MAIL_OVERLAP_MINUTES, TestViews, sql_with

TS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DTS = "%Y-%m-%d %H:%M:%S.%f"


def mail_run(v: TestViews):
    marks = M.effective_marks(v.messages, v.state, v.run_at, BACKFILL_DAYS)
    excl = M.excluded_folder_ids(v.folders, EXCLUDE_FOLDERS)
    flags = M.classify(v.messages, marks, v.index_ids, v.internet_index, v.skipped, excl,
                       v.failures, MAIL_OVERLAP_MINUTES)
    return marks, flags, M.run_mail(flags)


def q_mail_incremental(spark, sf_dir):
    _, _, run = mail_run(TestViews(spark, sf_dir))
    return run.filter("processed").select(
        "profile", "id", F.date_format("received", TS).alias("received"), "outcome")


def q_mail_outcomes(spark, sf_dir):
    _, _, run = mail_run(TestViews(spark, sf_dir))
    return (run.filter("processed").groupBy("profile", "outcome")
            .agg(F.count("*").alias("n")))


def q_high_water_mark(spark, sf_dir):
    marks, _, run = mail_run(TestViews(spark, sf_dir))
    return M.run_summary(run, marks)


def q_failure_islands(spark, sf_dir):
    _, _, run = mail_run(TestViews(spark, sf_dir))
    return M.failure_runs(run)


def q_strikes(spark, sf_dir):
    _, _, run = mail_run(TestViews(spark, sf_dir))
    return M.strikes(run)


def q_alias_backfill(spark, sf_dir):
    _, _, run = mail_run(TestViews(spark, sf_dir))
    return M.alias_backfill(run)


def q_mail_backfill(spark, sf_dir):
    v = TestViews(spark, sf_dir)
    marks = M.effective_marks(v.messages, v.state, v.run_at, BACKFILL_DAYS)
    cand = M.candidates(v.messages, marks, MAIL_OVERLAP_MINUTES)
    firsts = M.first_occurrence(cand.drop("mark")).join(marks, "profile")
    return firsts.groupBy("profile", "source").agg(
        F.date_format(F.first("mark"), TS).alias("mark"),
        F.count("*").alias("candidates"),
        F.date_format(F.min("received"), TS).alias("first_received"))


def q_folder_closure(spark, sf_dir):
    v = TestViews(spark, sf_dir)
    return M.folder_closure(v.tree).select("folder_id", "ancestor_id", F.col("depth").cast("bigint"))


def q_path_collisions(spark, sf_dir):
    v = TestViews(spark, sf_dir)
    firsts = M.first_occurrence(v.messages)
    empresa = F.concat(F.lit("acme-"), F.col("profile").cast("string"))
    return M.collision_paths(firsts, empresa).select("profile", "id", "path")


def q_tie_groups(spark, sf_dir):
    v = TestViews(spark, sf_dir)
    return M.tie_groups(v.messages, F.date_trunc("hour", F.col("received")))


PHRASE = "und die"
SINCE = "2024-01-01 12:00:00"


def q_phrase_search(spark, sf_dir):
    """F5 + F3: subject, body and sender of the documents as messages, since a time."""
    m = TestViews(spark, sf_dir).doc_messages
    sender = F.concat_ws(" ", F.col("from_entry.emailAddress.name"), F.col("from_entry.emailAddress.address"))
    docs = m.select("id", F.col("lang").alias("folder_id"), "cuenta", "subject", F.col("content").alias("body"),
                    sender.alias("sender"), "received")
    since = F.col("received") >= F.lit(SINCE).cast("timestamp_ntz")
    return M.phrase_search(docs, PHRASE, since).select("id", "folder_id", "cuenta")


def q_phrase_index(spark, sf_dir):
    """F5 over a positional index that two batches built: the same messages as
    the scan of subject, body and sender finds."""
    from ..operators import search as S
    from ..session import run_dir
    m = TestViews(spark, sf_dir).doc_messages
    sender = F.concat_ws(" ", F.col("from_entry.emailAddress.name"), F.col("from_entry.emailAddress.address"))
    docs = m.select("id", "doc_id", F.col("lang").alias("folder_id"), "cuenta", "subject", F.col("content").alias("body"),
                    sender.alias("sender"), "received")
    path = run_dir(spark, "phrase-index")
    for batch in (0, 1):
        S.add_batch(docs.filter(F.col("doc_id") % 2 == batch), path, batch, ("subject", "body", "sender"))
    since = F.col("received") >= F.lit(SINCE).cast("timestamp_ntz")
    return S.search(docs, path, PHRASE).filter(since).select("id", "folder_id", "cuenta")


def q_newest(spark, sf_dir):
    v = TestViews(spark, sf_dir)
    firsts = M.first_occurrence(v.messages)
    return M.newest(firsts, ["profile", "folder_id"]).select(
        "profile", "folder_id", "id", F.col("rank").cast("bigint"))


QUERIES = {
    "mail_incremental": q_mail_incremental,
    "mail_outcomes": q_mail_outcomes,
    "high_water_mark": q_high_water_mark,
    "failure_islands": q_failure_islands,
    "strikes": q_strikes,
    "alias_backfill": q_alias_backfill,
    "mail_backfill": q_mail_backfill,
    "folder_closure": q_folder_closure,
    "path_collisions": q_path_collisions,
    "tie_groups": q_tie_groups,
    "phrase_search": q_phrase_search,
    "phrase_index": q_phrase_index,
    "newest_per_folder": q_newest,
}

# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB). Sequential rules written the direct way: windows over
# the whole profile, which is what the Spark plan must reproduce.
# ---------------------------------------------------------------------------


def _closure(src: str) -> str:
    return f"""
        SELECT folder_id, folder_id AS ancestor_id, 0 AS depth FROM {src}
        UNION ALL
        SELECT c.folder_id, f.parent_id, c.depth + 1 FROM {{self}} c JOIN {src} f ON c.ancestor_id = f.folder_id
        WHERE f.parent_id IS NOT NULL AND f.parent_id <> '' AND f.parent_id <> c.ancestor_id """


_EXCL = ", ".join(f"'{n}'" for n in EXCLUDE_FOLDERS)

MAIL_CTES = {
    "marks": """
        SELECT p.profile, COALESCE(s.marca, r.run_at - INTERVAL 30 DAY) AS mark,
               CASE WHEN s.marca IS NULL THEN 'backfill' ELSE 'state' END AS source
        FROM (SELECT DISTINCT profile FROM v_messages) p LEFT JOIN v_state s USING (profile) CROSS JOIN v_run r""",
    "closure": _closure("v_folders").format(self="closure"),
    "excluded_ids": f"""
        SELECT DISTINCT folder_id FROM closure
        WHERE ancestor_id IN (SELECT folder_id FROM v_folders WHERE folder_id IN ({_EXCL}))""",
    "cand": f"""
        SELECT m.* FROM v_messages m JOIN marks k USING (profile)
        WHERE m.received IS NULL OR m.received >= k.mark - INTERVAL {MAIL_OVERLAP_MINUTES} MINUTE""",
    "firsts": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY profile, id ORDER BY received, pos) AS rn FROM cand) WHERE rn = 1""",
    "flags0": """
        SELECT f.*,
          (EXISTS (SELECT 1 FROM v_index i WHERE i.profile = f.profile AND i.id = f.id)
           OR EXISTS (SELECT 1 FROM v_skip s WHERE s.profile = f.profile AND s.id = f.id)) AS known_id,
          (f.internet_id <> '' AND EXISTS (SELECT 1 FROM v_internet_index n
             WHERE n.profile = f.profile AND n.internet_id = f.internet_id)) AS known_inet,
          EXISTS (SELECT 1 FROM v_index i WHERE i.profile = f.profile AND i.id = f.id) AS in_index,
          f.folder_id IN (SELECT folder_id FROM excluded_ids) AS in_excluded,
          x.prior_strikes, x.id IS NOT NULL AS fails
        FROM firsts f LEFT JOIN v_fail x ON x.profile = f.profile AND x.id = f.id""",
    "flags1": """
        SELECT *, known_id OR known_inet AS known0,
          NOT (known_id OR known_inet) AND in_excluded AS excluded0,
          NOT (known_id OR known_inet) AND NOT in_excluded AND received IS NOT NULL AND fails AS failing0,
          row_number() OVER (PARTITION BY profile ORDER BY received NULLS FIRST, id) AS n0
        FROM flags0""",
    # an internet id is recorded once a row that carries it is written: known from the next row on
    "flags2": """
        SELECT *, internet_id <> '' AND coalesce(n0 > min(n0) FILTER (
            WHERE NOT known0 AND NOT excluded0 AND NOT failing0 AND received IS NOT NULL)
            OVER (PARTITION BY profile, internet_id), false) AS again
        FROM flags1""",
    "flags": """
        SELECT *, known0 OR again AS known, excluded0 AND NOT again AS excluded, failing0 AND NOT again AS failing,
          failing0 AND NOT again AND coalesce(prior_strikes, 0) + 1 >= 3 AS strike3,
          (known_inet OR again) AND NOT in_index AS alias_only
        FROM flags2""",
    "seq": """
        SELECT *,
          coalesce(sum(CASE WHEN NOT known AND NOT (failing AND NOT strike3) THEN 1 ELSE 0 END) OVER (
            PARTITION BY profile ORDER BY received NULLS FIRST, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS counted_before,
          sum(CASE WHEN failing THEN 0 ELSE 1 END) OVER (
            PARTITION BY profile ORDER BY received NULLS FIRST, id ROWS UNBOUNDED PRECEDING) AS resets_cum,
          n0 AS n
        FROM flags""",
    "runs": """
        SELECT *, CASE WHEN failing THEN row_number() OVER (
          PARTITION BY profile, resets_cum, failing ORDER BY received, id) END AS run_len FROM seq""",
    "stops": """
        SELECT profile, CAST(NULL AS BIGINT) AS cap_n,
          min(n) FILTER (WHERE failing AND NOT strike3 AND run_len >= 5) AS err_n
        FROM runs GROUP BY profile""",
    "run": """
        SELECT r.*, s.cap_n, s.err_n,
          (s.cap_n IS NULL OR r.n < s.cap_n) AND (s.err_n IS NULL OR r.n <= s.err_n) AS processed,
          CASE WHEN known THEN 'known' WHEN excluded THEN 'excluded' WHEN received IS NULL THEN 'skipped'
               WHEN strike3 THEN 'skipped' WHEN failing THEN 'failed' ELSE 'written' END AS outcome
        FROM runs r JOIN stops s USING (profile)""",
}
_MAIL_DEPS = {
    "marks": ["v_messages", "v_state", "v_run"], "closure": ["v_folders"],
    "excluded_ids": ["closure"], "cand": ["v_messages", "marks"], "firsts": ["cand"],
    "flags0": ["firsts", "v_index", "v_skip", "v_internet_index", "excluded_ids", "v_fail"],
    "flags1": ["flags0"], "flags2": ["flags1"], "flags": ["flags2"], "seq": ["flags"], "runs": ["seq"], "stops": ["runs"], "run": ["runs", "stops"],
}


def _mail_sql(body: str, upto: str = "run", more: dict[str, str] | None = None) -> str:
    order = ["marks", "closure", "excluded_ids", "cand", "firsts", "flags0", "flags1", "flags2", "flags", "seq", "runs", "stops", "run"]
    keep = {k: MAIL_CTES[k] for k in order[: order.index(upto) + 1]}
    keep.update(more or {})
    deps = dict(_MAIL_DEPS)
    deps["marks"] = [*deps["marks"], "v_snapshot", "v_fail"]
    prev = upto
    for k in (more or {}):
        deps[k] = [prev]
        prev = k
    return "WITH RECURSIVE " + sql_with(body, extra=keep, extra_deps=deps)[len("WITH "):]


ORACLE = {
    "mail_incremental": _mail_sql(f"""
        SELECT profile, id, strftime(received, '{DTS}') AS received, outcome FROM run WHERE processed"""),
    "mail_outcomes": _mail_sql("""
        SELECT profile, outcome, count(*) AS n FROM run WHERE processed GROUP BY profile, outcome"""),
    "high_water_mark": _mail_sql(f"""
        SELECT k.profile, strftime(k.mark, '{DTS}') AS mark,
          strftime(CASE WHEN a.advanced_to > k.mark THEN a.advanced_to ELSE k.mark END, '{DTS}') AS new_mark,
          coalesce(a.processed, 0) AS processed, coalesce(a.written, 0) AS written,
          coalesce(a.known, 0) AS known, coalesce(a.excluded, 0) AS excluded,
          coalesce(a.errors, 0) AS errors, coalesce(a.skipped_now, 0) AS skipped_now,
          CASE WHEN s.err_n IS NOT NULL AND (s.cap_n IS NULL OR s.err_n < s.cap_n) THEN 'errores'
               WHEN s.cap_n IS NOT NULL THEN 'tope' ELSE '' END AS stop,
          CASE WHEN coalesce(a.errors, 0) - coalesce(a.skipped_now, 0) > 0
               THEN 'error: ' || (coalesce(a.errors, 0) - coalesce(a.skipped_now, 0)) || ' correos sin escribir'
               ELSE 'ok' END AS status
        FROM marks k LEFT JOIN agg a USING (profile) LEFT JOIN stops s USING (profile)""", more={
        "ff": """SELECT profile, min(n) AS first_fail_n FROM run
                 WHERE processed AND failing AND NOT strike3 GROUP BY profile""",
        "agg": """
          SELECT r.profile,
            max(received) FILTER (WHERE ff.first_fail_n IS NULL OR r.n < ff.first_fail_n) AS advanced_to,
            count(*) AS processed, count(*) FILTER (WHERE outcome = 'written') AS written,
            count(*) FILTER (WHERE outcome = 'known') AS known,
            count(*) FILTER (WHERE outcome = 'excluded') AS excluded,
            count(*) FILTER (WHERE failing) AS errors, count(*) FILTER (WHERE strike3) AS skipped_now
          FROM run r LEFT JOIN ff USING (profile) WHERE processed GROUP BY r.profile"""}),
    "failure_islands": _mail_sql("""
        SELECT profile, arg_min(id, n) AS first_id, count(*) AS n_failures,
               count(*) FILTER (WHERE strike3) AS n_strike3,
               coalesce(bool_or(n = err_n), false) AS stopped_run
        FROM run WHERE processed AND failing GROUP BY profile, resets_cum"""),
    "strikes": _mail_sql("""
        SELECT profile, id, prior_strikes + 1 AS strikes, strike3 AS to_skip_list
        FROM run WHERE processed AND failing"""),
    "alias_backfill": _mail_sql("SELECT profile, id, internet_id FROM run WHERE processed AND alias_only"),
    "mail_backfill": _mail_sql(f"""
        SELECT profile, source, strftime(any_value(mark), '{DTS}') AS mark, count(*) AS candidates,
               strftime(min(received), '{DTS}') AS first_received
        FROM firsts JOIN marks USING (profile) GROUP BY profile, source""", upto="firsts"),
    "folder_closure": "WITH RECURSIVE " + sql_with(
        "SELECT folder_id, ancestor_id, CAST(depth AS BIGINT) AS depth FROM tclosure", "v_tree",
        extra={"tclosure": _closure("v_tree").format(self="tclosure")},
        extra_deps={"tclosure": ["v_tree"]})[len("WITH "):],
    "tie_groups": sql_with("""
        SELECT profile, strftime(date_trunc('hour', received), '%Y-%m-%d %H:%M:%S') AS bucket, count(*) AS n,
               count(*) > 50 AS grows_page, count(*) > 1000 AS skips_second
        FROM v_messages GROUP BY profile, date_trunc('hour', received) HAVING count(*) > 1""", "v_messages"),
    "phrase_search": sql_with(f"""
        SELECT id, lang AS folder_id, cuenta FROM v_docmail
        WHERE received >= TIMESTAMP '{SINCE}' AND (contains(lower(coalesce(subject, '')), '{PHRASE}')
              OR contains(lower(coalesce(body_text, '')), '{PHRASE}')
              OR contains(lower(concat_ws(' ', from_name, from_address)), '{PHRASE}'))""", "v_docmail"),
    "newest_per_folder": _mail_sql("""
        SELECT profile, folder_id, id, rank FROM (
          SELECT profile, folder_id, id, row_number() OVER (
            PARTITION BY profile, folder_id ORDER BY received DESC, id DESC) AS rank FROM allfirst)""".replace("allfirst", "(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
                                     "(PARTITION BY profile, id ORDER BY received, pos) AS rn FROM v_messages) "
                                     "WHERE rn = 1)"), upto="marks"),
}
ORACLE["phrase_index"] = ORACLE["phrase_search"]
