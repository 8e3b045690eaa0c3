"""Named text / time queries (X1-X19, X30) over whole documents, pages,
events and line items, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import people as P
from ..functions import text as X
from ..functions import times as TM
from ..sources.testdata import TestViews, sql_with
from . import sqlfn as Q

CUT_BYTES = 1024  # utf8_cut byte budget (the operator's parameter; the mail cap is 100 KiB)


def _sha(c):
    return F.sha1(F.encode(c, "UTF-8"))


def q_slug_ascii(spark, sf_dir):
    d = TestViews(spark, sf_dir).docs
    return d.select("id", X.slug_ascii("subject").alias("slug"))


def q_slug_plain(spark, sf_dir):
    d = TestViews(spark, sf_dir).docs
    return d.select("id", X.slug_plain("subject").alias("slug"))


def q_short_hash(spark, sf_dir):
    d = TestViews(spark, sf_dir).docs
    return d.select("id", X.sha_hex("id", 6).alias("sha6"), X.sha_hex("subject", 8).alias("sha8"))


def q_one_line(spark, sf_dir):
    d = TestViews(spark, sf_dir).docs
    t = X.one_line("body")
    return d.select("id", F.char_length(t).cast("bigint").alias("n_chars"), _sha(t).alias("sha1"))


def q_utf8_cut(spark, sf_dir):
    d = TestViews(spark, sf_dir).docs
    cut = X.truncate_utf8("body", CUT_BYTES)
    return d.select("id", X.utf8_bytes("body").cast("bigint").alias("n_bytes"),
                    (X.utf8_bytes("body") > CUT_BYTES).alias("truncated"),
                    F.char_length(cut).cast("bigint").alias("cut_chars"), _sha(cut).alias("cut_sha1"))


def q_size_label(spark, sf_dir):
    li = TestViews(spark, sf_dir).table("lineitem")
    size = F.floor("l_extendedprice").cast("bigint")
    return li.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
                     size.alias("size"), X.size_label(size).alias("label"))


def q_html_text(spark, sf_dir):
    h = H.html_to_text(TestViews(spark, sf_dir).html, "body", "text")
    return h.select("id", F.char_length("text").cast("bigint").alias("n_chars"), _sha(F.col("text")).alias("sha1"))


def q_time_formats(spark, sf_dir):
    e = TestViews(spark, sf_dir).events
    raw = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("7"),
                   F.when(F.col("event_id") % 2 == 0, F.lit("Z")).otherwise(F.lit("")))
    return e.select(
        "event_id", TM.iso_z("ts").alias("iso_z"), TM.local_iso("ts").alias("local_iso"),
        TM.hhmm("ts").alias("hhmm"), F.date_format(TM.local_date("ts"), "yyyy-MM-dd").alias("local_date"),
        TM.digest_local("ts").alias("digest_local"),
        F.date_format(TM.parse_graph_ts(raw), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("parsed"))


def q_person_labels(spark, sf_dir):
    d = TestViews(spark, sf_dir).table("documents")
    addr = F.when(F.col("doc_id") % 5 == 0, F.lit("")).otherwise(
        F.concat(F.lit(" <"), F.upper("lang"), F.lit("."), F.col("doc_id").cast("string"), F.lit("@Example.COM> ")))
    name = F.concat(F.lit('"'), F.col("text"), F.lit('" '))
    label = P.person_label(name, addr)
    return d.select("doc_id", label.alias("label"), P.person_key(label).alias("key"))


def q_quoted_scalars(spark, sf_dir):
    d = TestViews(spark, sf_dir).docs
    return d.select("id", X.yaml_quote("subject").alias("quoted"), X.yaml_escape("subject").alias("escaped"))


QUERIES = {
    "slug_ascii": q_slug_ascii,
    "slug_plain": q_slug_plain,
    "short_hash": q_short_hash,
    "one_line": q_one_line,
    "utf8_cut": q_utf8_cut,
    "size_label": q_size_label,
    "html_text": q_html_text,
    "time_formats": q_time_formats,
    "person_labels": q_person_labels,
    "quoted_scalars": q_quoted_scalars,
}

# ---------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------
_RESERVED = ", ".join(f"'{n}'" for n in X.RESERVED_NAMES)


def _slug_tail(dashed: str, fallback: str, max_chars: int | None) -> str:
    t = f"regexp_replace({dashed}, '^-+|-+$', '', 'g')"
    if max_chars is not None:
        cut = f"left({t}, {max_chars})"
        back = f"strpos(reverse({cut}), '-')"
        last = f"(length({cut}) - {back} + 1)"
        keep = f"(CASE WHEN {back} > 0 AND {last} >= {max_chars // 2 + 1} THEN {last} - 1 ELSE length({cut}) END)"
        t = (f"(CASE WHEN length({t}) > {max_chars} THEN regexp_replace(left({cut}, {keep}), '^-+|-+$', '', 'g') "
             f"ELSE {t} END)")
    t = f"(CASE WHEN {t} = '' THEN '{fallback}' ELSE {t} END)"
    return f"(CASE WHEN {t} IN ({_RESERVED}) THEN 'item-' || {t} ELSE {t} END)"


def _yaml_quote_sql(x: str) -> str:
    c = f"coalesce({x}, '')"
    for a, b in (("\\", "\\\\"), ('"', '\\"')):
        c = f"replace({c}, '{a}', '{b}')"
    for ch, esc in (("10", "\\n"), ("13", "\\r"), ("9", "\\t")):
        c = f"replace({c}, chr({ch}), '{esc}')"
    for code in X._LONG_ESCAPE_CODES:
        c = f"replace({c}, chr({code}), '\\u{code:04x}')"
    return f"('\"' || {c} || '\"')"


def _cut_sql(n: int) -> dict[str, str]:
    ctes = {"c0": f"SELECT id, body, 0 AS lo, least(length(coalesce(body, '')), {n}) AS hi FROM v_docs"}
    steps = n.bit_length() + 1
    for i in range(1, steps + 1):
        mid = "((lo + hi + 1) // 2)"
        ok = f"strlen(left(coalesce(body, ''), {mid})) <= {n}"
        ctes[f"c{i}"] = (f"SELECT id, body, CASE WHEN {ok} THEN {mid} ELSE lo END AS lo, "
                         f"CASE WHEN {ok} THEN hi ELSE {mid} - 1 END AS hi FROM c{i - 1}")
    return ctes


def _html_sql(x: str) -> str:
    c = f"coalesce({x}, '')"
    for pattern, repl in H.MARKUP_RULES:
        r = repl.replace("\n", "' || chr(10) || '")
        c = f"regexp_replace({c}, '{pattern}', '{r}', 'g')"
    for ent, ch in (("&middot;", "chr(183)"), ("&copy;", "chr(169)"), ("&nbsp;", "chr(160)"), ("&quot;", "'\"'"),
                    ("&#39;", "''''"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&amp;", "'&'")):
        c = f"replace({c}, '{ent}', {ch})"
    c = f"regexp_replace({c}, '[ \\t\\x{{a0}}]+\\n', chr(10), 'g')"
    c = f"regexp_replace({c}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return f"regexp_replace({c}, '^{Q.WS}+|{Q.WS}+$', '', 'g')"


_cut = _cut_sql(CUT_BYTES)
_cut_deps = {f"c{i}": [f"c{i - 1}"] if i else ["v_docs"] for i in range(len(_cut))}
_last = f"c{len(_cut) - 1}"

ORACLE = {
    "slug_ascii": sql_with(f"""
        SELECT id, {_slug_tail("regexp_replace(lower(regexp_replace(strip_accents(coalesce(subject, '')), '[^\\x00-\\x7f]', '', 'g')), '[^a-z0-9]+', '-', 'g')", X.SLUG_FALLBACK, X.SLUG_MAX_CHARS)} AS slug
        FROM v_docs""", "v_docs"),
    "slug_plain": sql_with(f"""
        SELECT id, {_slug_tail("regexp_replace(lower(coalesce(subject, '')), '[^a-z0-9]+', '-', 'g')", X.PLAIN_SLUG_FALLBACK, None)} AS slug
        FROM v_docs""", "v_docs"),
    "short_hash": sql_with("SELECT id, left(sha1(id), 6) AS sha6, left(sha1(coalesce(subject, '')), 8) AS sha8 FROM v_docs",
                           "v_docs"),
    "one_line": sql_with(f"""
        SELECT id, CAST(length({Q.one_line('body')}) AS BIGINT) AS n_chars, sha1({Q.one_line('body')}) AS sha1
        FROM v_docs""", "v_docs"),
    "utf8_cut": sql_with(f"""
        SELECT id, CAST(strlen(coalesce(body, '')) AS BIGINT) AS n_bytes, strlen(coalesce(body, '')) > {CUT_BYTES} AS truncated,
               CAST(lo AS BIGINT) AS cut_chars, sha1(left(coalesce(body, ''), lo)) AS cut_sha1 FROM {_last}""",
                         extra=_cut, extra_deps=_cut_deps),
    "size_label": """
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(floor(l_extendedprice) AS BIGINT) AS size,
               CAST(greatest(1, CAST(round_even(CAST(floor(l_extendedprice) AS BIGINT) / 1024.0, 0) AS BIGINT)) AS VARCHAR)
               || ' KB' AS label
        FROM lineitem""",
    "html_text": sql_with(f"""
        SELECT id, CAST(length(t) AS BIGINT) AS n_chars, sha1(t) AS sha1
        FROM (SELECT id, {_html_sql('body')} AS t FROM v_html)""", "v_html"),
    "time_formats": """
        SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso_z, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS local_iso,
               strftime(ts, '%H%M') AS hhmm, strftime(ts, '%Y-%m-%d') AS local_date,
               strftime(ts, '%Y-%m-%d %H:%M') AS digest_local, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS parsed
        FROM events""",
    "person_labels": f"""
        SELECT doc_id, {Q.person_label("'\"' || text || '\" '", "a")} AS label,
               {Q.person_key(Q.person_label("'\"' || text || '\" '", "a"))} AS key
        FROM (SELECT *, CASE WHEN doc_id % 5 = 0 THEN '' ELSE ' <' || upper(lang) || '.' || doc_id || '@Example.COM> ' END AS a
              FROM documents)""",
    "quoted_scalars": sql_with(f"""
        SELECT id, {_yaml_quote_sql('subject')} AS quoted,
          CASE WHEN subject IS NULL THEN 'null'
               WHEN regexp_matches(subject, '[:#\\n"''\\[\\]{{}}]') THEN '"' || replace(replace(subject, '\\', '\\\\'), '"', '\\"') || '"'
               ELSE subject END AS escaped
        FROM v_docs""", "v_docs"),
}
