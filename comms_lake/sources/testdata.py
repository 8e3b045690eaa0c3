"""Views over the driver's parquet tables.

The driver's tables stand in for landed mailbox, calendar and transcript
data. Each view below is defined twice, side by side: a Spark builder (the
implementation) and a DuckDB CTE (used only by the correctness oracle).
Every view is a row-wise mapping or a join of whole tables, so its size
grows with the scale factor.

Scenario parameters are fixed values of the test mapping, listed together:
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.documents import with_attachments, with_folder_name
from ..session import literal_table

# --- fixed values of the test mapping -------------------------------------
CUSTOMERS_PER_CALENDAR = 10         # spans: one profile per ten customers; mail and timed: one per user
EXCLUDE_FOLDERS = ["junkemail", "deleteditems", "drafts"]   # profile default
MAIL_OVERLAP_MINUTES = 10
BACKFILL_DAYS = 30
MEETINGS_LOOKBACK_DAYS = 31         # settable per profile; covers the data
ZONE = "UTC"
# Folder tree (id, displayName, parentFolderId); root is its own parent.
FOLDERS = [
    ("root", "Raíz", "root"),
    ("inbox", "Bandeja de entrada", "root"),
    ("junkemail", "Correo no deseado", "root"),
    ("deleteditems", "Elementos eliminados", "root"),
    ("click", "Clics", "inbox"),
    ("view", "Vistas", "inbox"),
    ("purchase", "Compras", "inbox"),
    ("error", "Errores", "junkemail"),
    ("signup", "Altas", "deleteditems"),
    ("en", "Entrada EN", "inbox"),
    ("fr", "Entrée FR", "inbox"),
]


def _tbl(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _user_address(u: Column) -> Column:
    return F.concat(F.lit("u"), u.cast("string"), F.lit("@example.com"))


def _user_entry(u: Column, upper: bool = False) -> Column:
    addr = _user_address(u)
    return F.struct(F.struct(
        F.concat(F.lit("Usuario "), u.cast("string")).alias("name"),
        (F.upper(addr) if upper else addr).alias("address")).alias("emailAddress"))


def _user_name(u: Column) -> Column:
    return F.concat(F.lit("Usuario "), u.cast("string"))


def _name_address(name: Column) -> Column:
    return F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("."))), F.lit("@example.com"))


def _attendee(kind: Column, name: Column, address: Column) -> Column:
    return F.struct(kind.alias("type"),
                    F.struct(name.alias("name"), address.alias("address")).alias("emailAddress"))


class TestViews:
    """Spark views for one scale-factor directory (lazy, cached per object)."""

    def __init__(self, spark: SparkSession, sf_dir: str, streaming: bool = False):
        """``streaming``: tables are read as file streams (for the row-wise views)."""
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.streaming = streaming

    def table(self, name: str) -> DataFrame:
        batch = _tbl(self.spark, self.sf_dir, name)
        if not self.streaming:
            return batch
        # a pattern, as a table may be one file or a folder of files
        return self.spark.readStream.schema(batch.schema).parquet(f"{self.sf_dir}/{name}.parquet*")

    # -- mail ---------------------------------------------------------------
    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").select(
            "event_id", "ts", "user_id", "event_type", "value",
            F.get_json_object("props", "$.k").cast("bigint").alias("k"))

    @cached_property
    def messages(self) -> DataFrame:
        """One row per listed message; ids with event_id % 5 = 0 are listed a
        second time (a re-read page, pos 1). A user's messages of one day
        share ten internet ids, so some come twice in one run."""
        e = self.events
        day = F.date_format("ts", "yyyyMMdd")
        base = e.select(
            F.col("user_id").alias("profile"),
            F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("id"),
            F.when((F.col("event_id") % 11 == 0) | self.fails(F.col("ts")), F.lit("")).otherwise(
                F.concat(F.lit("<"), F.expr("k div 10").cast("string"), F.lit("."), day, F.lit("."),
                         F.col("user_id").cast("string"), F.lit("@mail.example>"))
            ).alias("internet_id"),
            F.col("ts").alias("received"),
            F.col("event_type").alias("folder_id"),
            F.col("event_type").alias("subject"),
            "event_id", "user_id", "k",
            F.explode(F.when(F.col("event_id") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
            .alias("pos"))
        return base  # one scan; the re-read copy is a second generated row

    @cached_property
    def snapshot(self) -> DataFrame:
        """The mailbox at the time of the re-check: every third message has
        moved to the inbox, every third is gone."""
        e = self.events.filter(F.col("event_id") % 3 != 1)
        return e.select(F.col("user_id").alias("profile"), F.concat(F.lit("m"), F.col("event_id").cast("string")).alias("id"),
                        F.when(F.col("event_id") % 3 == 0, F.lit("inbox")).otherwise(F.col("event_type")).alias("folder_id"))

    @cached_property
    def folders(self) -> DataFrame:
        return literal_table(self.spark, FOLDERS, "folder_id string, display_name string, parent_id string")

    @cached_property
    def tree(self) -> DataFrame:
        """Bigger folder tree: region root, nation child, customer leaf."""
        r = self.table("region").select(
            F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("folder_id"),
            F.col("r_name").alias("display_name"), F.lit("root").alias("parent_id"))
        n = self.table("nation").select(
            F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("folder_id"),
            F.col("n_name").alias("display_name"),
            F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("parent_id"))
        c = self.table("customer").select(
            F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("folder_id"),
            F.col("c_name").alias("display_name"),
            F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("parent_id"))
        return self.folders.unionByName(r).unionByName(n).unionByName(c)

    @cached_property
    def first_listing(self) -> DataFrame:
        return self.messages.filter(F.col("pos") == 0)

    @cached_property
    def index_ids(self) -> DataFrame:
        """Ids written by earlier runs (seen_ids)."""
        return self.first_listing.filter(F.col("event_id") % 7 == 0).select("profile", "id")

    @cached_property
    def internet_index(self) -> DataFrame:
        return (self.first_listing.filter((F.col("event_id") % 7 == 0) & (F.col("internet_id") != ""))
                .select("profile", "internet_id"))

    @cached_property
    def skipped(self) -> DataFrame:
        return self.first_listing.filter(F.col("event_id") % 97 == 0).select("profile", "id")

    @cached_property
    def failures(self) -> DataFrame:
        """Writes that raise this run, with the strikes of earlier runs."""
        m = self.first_listing.filter(self.fails(F.col("received")))
        return m.select("profile", "id", (F.col("event_id") % 3).alias("prior_strikes"))

    @staticmethod
    def fails(ts: Column) -> Column:
        """Scattered failures, and some users' outage of four days."""
        return ((F.col("user_id") % 7 == 3) & F.dayofmonth(ts).between(20, 23)) | (F.col("k") % 23 == 0)

    @cached_property
    def run_at(self) -> DataFrame:
        return self.events.agg(F.max("ts").alias("run_at"))

    @cached_property
    def state(self) -> DataFrame:
        """Saved high-water marks; every third profile has none (first run)."""
        m = self.first_listing.filter(F.col("profile") % 3 < 2)
        days = (F.lit(3) + F.col("profile") % 3 * 5).cast("int")
        return (m.groupBy("profile").agg(F.min("received").alias("first_seen"))
                .select("profile", (F.col("first_seen") + F.make_dt_interval(days=days)).alias("marca")))

    # -- calendar ----------------------------------------------------------------
    @cached_property
    def timed(self) -> DataFrame:
        """Calendar events from ``events``: timed (start=ts, end=ts+floor(value)
        minutes) or all-day (event_id % 10 = 0, 1-3 literal days)."""
        e = self.events
        u, eid = F.col("user_id"), F.col("event_id")
        room_no = (eid % 4).cast("string")
        room = _attendee(F.lit("resource"), F.concat(F.lit("Sala "), room_no),
                         F.concat(F.lit("sala"), room_no, F.lit("@example.com")))
        people = F.array(_attendee(F.lit("required"), _user_name(u + 1), _user_address(u + 1)),
                         _attendee(F.lit("optional"), _user_name(u + 7), _user_address(u + 7)),
                         _attendee(F.lit("required"), _user_name(u), F.upper(_user_address(u))))
        all_day = eid % 10 == 0
        day0 = F.date_trunc("day", "ts").cast("timestamp_ntz")
        start = F.when(all_day, day0).otherwise(F.col("ts"))
        end = F.when(all_day, day0 + F.make_dt_interval(days=(F.lit(1) + eid % 3).cast("int"))).otherwise(
            F.col("ts") + F.make_dt_interval(mins=F.floor("value").cast("int")))
        join = (F.when(F.col("event_type").isin("click", "purchase"),
                       F.concat(F.lit("https://teams.microsoft.com/l/meetup-join/"), eid.cast("string")))
                .when(F.col("event_type") == "view", F.concat(F.lit("https://meet.example.com/j/"), eid.cast("string")))
                .otherwise(F.lit("")))
        return e.select(
            F.lit("timed").alias("calendar"), u.alias("profile"),
            F.concat(F.lit("e"), eid.cast("string")).alias("id"), "event_id",
            F.initcap("event_type").alias("subject"),
            start.alias("start_ts"), end.alias("end_ts"), all_day.alias("all_day"),
            (eid % 13 == 0).alias("cancelled"), join.alias("join_url"),
            (F.col("event_type") == "click").alias("is_online"),
            F.when(F.col("event_type") == "purchase", F.lit("teamsForBusiness")).otherwise(F.lit("unknown")).alias("provider"),
            _user_name(u).alias("org_name"), _user_address(u).alias("org_address"),
            F.when(eid % 4 == 0, F.concat(people, F.array(room))).otherwise(people).alias("attendees"),
            F.when(eid % 3 == 0, F.concat(F.lit("Sala "), room_no)).otherwise(F.lit("")).alias("location"))

    @cached_property
    def spans(self) -> DataFrame:
        """Multi-day events from orders: start=o_orderdate, end=start +
        (o_orderkey % 70) days; organizer = customer; attendees = suppliers of
        the order's lines in (l_linenumber, l_suppkey, l_partkey) order, rooms
        when suppkey % 5 = 0."""
        li = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
        su = self.table("supplier").select("s_suppkey", "s_name")
        # attendees are made behind the shuffle: it moves keys and a name a line
        att = (li.join(su, li.l_suppkey == su.s_suppkey)
               .groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(
                   "l_linenumber", "l_suppkey", "l_partkey", "s_name"))).alias("__a"))
               .select(F.col("l_orderkey").alias("o_orderkey"), F.transform("__a", lambda x: _attendee(
                   F.when(x["l_suppkey"] % 5 == 0, F.lit("resource")).otherwise(F.lit("required")),
                   x["s_name"], _name_address(x["s_name"]))).alias("attendees")))
        cu = self.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
        k = F.col("o_orderkey")
        return (o.join(cu, "o_custkey", "left").join(att, "o_orderkey", "left").select(
            F.lit("spans").alias("calendar"), F.expr(f"o_custkey div {CUSTOMERS_PER_CALENDAR}").alias("profile"),
            F.concat(F.lit("o"), k.cast("string")).alias("id"), k.alias("event_id"),
            F.concat(F.lit("Pedido "), k.cast("string")).alias("subject"),
            F.col("o_orderdate").alias("start_ts"),
            (F.col("o_orderdate") + F.make_dt_interval(days=(k % 70).cast("int"))).alias("end_ts"),
            (k % 2 == 0).alias("all_day"), (F.col("o_orderstatus") == "F").alias("cancelled"),
            F.lit("").alias("join_url"), F.lit(False).alias("is_online"), F.lit("").alias("provider"),
            F.col("c_name").alias("org_name"), _name_address(F.col("c_name")).alias("org_address"),
            F.coalesce("attendees", F.array().cast(
                "array<struct<type:string,emailAddress:struct<name:string,address:string>>>")).alias("attendees"),
            F.lit("").alias("location")))

    # -- meetings ----------------------------------------------------------------
    @cached_property
    def online_meetings(self) -> DataFrame:
        """Join URL -> online meeting id for Teams events (event_id % 6 <> 0);
        consecutive event ids share a meeting; event_id % 8 = 0 also lists a
        second id for the same URL."""
        t = self.timed.filter(F.col("join_url").contains("teams.microsoft") & (F.col("event_id") % 6 != 0))
        one = t.select("join_url", F.concat(F.lit("om"), F.expr("event_id div 2").cast("string")).alias("meeting_id"))
        two = t.filter(F.col("event_id") % 8 == 0).select(
            "join_url", F.concat(F.lit("omx"), F.col("event_id").cast("string")).alias("meeting_id"))
        return one.unionByName(two)

    @cached_property
    def transcripts(self) -> DataFrame:
        """One transcript per conversation, VTT rebuilt from its turns in order."""
        c = self.cues
        pos = F.col("pos")
        secs = pos * 7
        h, m, sc = (secs / 3600).cast("int"), ((secs / 60).cast("int") % 60), secs % 60

        def p2(x):
            return F.lpad(x.cast("string"), 2, "0")
        stamp = (F.when(pos % 3 == 0, F.concat(h.cast("string"), F.lit(":"), p2(m), F.lit(":"), p2(sc), F.lit(".000")))
                 .when(pos % 3 == 1, F.concat(p2(m), F.lit(":"), p2(sc), F.lit(",000")))
                 .otherwise(F.concat(p2(h), F.lit(":"), p2(m), F.lit(":"), p2(sc), F.lit(".000"))))
        e = secs + 5
        end = F.concat(p2((e / 3600).cast("int")), F.lit(":"), p2((e / 60).cast("int") % 60), F.lit(":"),
                       p2(e % 60), F.lit(".000"))
        voice = (F.when(F.col("speaker") == "user", F.concat(F.lit("<v Ana Pérez>"), "text", F.lit("</v>")))
                 .when(F.col("speaker") == "assistant", F.concat(F.lit("<v.loud Asistente Virtual>"), "text", F.lit("</v>")))
                 .otherwise(F.col("text")))
        block = F.concat_ws("\n", (pos + 1).cast("string"), F.concat(stamp, F.lit(" --> "), end), voice)
        g = c.groupBy("meeting").agg(F.array_sort(F.collect_list(F.struct("pos", block.alias("b")))).alias("__b"))
        return g.select(
            F.concat(F.lit("om"), F.col("meeting").cast("string")).alias("meeting_id"),
            F.concat(F.lit("t"), F.col("meeting").cast("string")).alias("transcript_id"),
            (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("meeting").cast("int"))).alias("created"),
            (F.col("meeting") % 7 != 3).alias("attributed"),
            F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.transform("__b", lambda x: x["b"]), "\n\n")).alias("vtt"))

    @cached_property
    def seen_transcripts(self) -> DataFrame:
        """Transcript index of each profile: those of its meetings with a number divisible by five."""
        t = self.timed.filter(F.col("join_url").contains("teams.microsoft") & (F.col("event_id") % 6 != 0))
        return (t.select("profile", F.expr("event_id div 2").alias("n")).filter(F.col("n") % 5 == 0)
                .select("profile", F.concat(F.lit("t"), F.col("n").cast("string")).alias("transcript_id")).distinct())

    @cached_property
    def refusals(self) -> DataFrame:
        """Meetings that the service refuses to show, with its reason."""
        t = self.timed.filter((F.col("event_id") % 17 == 0) & (F.col("join_url") != ""))
        return t.select("join_url", F.when(F.col("event_id") % 2 == 0, F.lit("Graph 403 Forbidden"))
                        .otherwise(F.lit("Graph 403 GraphAccessToTranscriptsDisabled")).alias("motive"))

    # -- documents, pages, cues ------------------------------------------------
    @cached_property
    def docs(self) -> DataFrame:
        return self.table("documents").select(
            F.col("doc_id"), F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"),
            F.col("text").alias("subject"), F.col("text").alias("body"),
            F.col("lang").alias("folder_id"), F.col("source").alias("profile"))

    @cached_property
    def doc_messages(self) -> DataFrame:
        """Documents as received messages with recipients and attachments:
        received = 2024-01-01 + 7 min x doc_id; ``from`` has no address when
        doc_id % 6 = 0 (sender fallback); attachments are the line items whose
        l_orderkey equals doc_id; the listing fails when doc_id % 50 = 0."""
        atts = self.table("lineitem").select(
            F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("pos"),
            F.concat(F.lit("pieza-"), F.col("l_partkey").cast("string"), F.lit(".pdf")).alias("name"),
            F.lit("application/pdf").alias("content_type"), F.floor("l_extendedprice").cast("bigint").alias("size"))
        d = with_attachments(self.table("documents"), atts, F.col("doc_id") % 50 == 0, "doc_id")
        d = with_folder_name(d, self.folders, "lang")
        src = F.col("source")
        entry = lambda n, a: F.struct(F.struct(n.alias("name"), a.alias("address")).alias("emailAddress"))
        return d.select(
            "doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"),
            F.concat(F.lit("<d"), F.col("doc_id").cast("string"), F.lit("@docs>")).alias("internet_id"),
            F.col("text").alias("subject"),
            (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
             + F.make_dt_interval(mins=(F.col("doc_id") * 7).cast("int"))).alias("received"),
            entry(F.concat(F.lit("Autor "), src),
                  F.when(F.col("doc_id") % 6 == 0, F.lit("")).otherwise(F.concat(src, F.lit("@example.com")))).alias("from_entry"),
            entry(F.concat(F.lit("Buzón "), src), F.concat(F.lit("buzon."), src, F.lit("@example.com"))).alias("sender_entry"),
            F.array(entry(F.concat(F.lit("Lector "), F.col("lang")), F.concat(F.col("lang"), F.lit("@example.com"))),
                    entry(F.concat(F.lit("Autor "), src), F.upper(F.concat(src, F.lit("@example.com"))))).alias("to_entries"),
            F.when(F.col("doc_id") % 4 == 0, F.array(entry(F.lit("Copia"), F.lit("copia@example.com")))).otherwise(
                F.array().cast("array<struct<emailAddress:struct<name:string,address:string>>>")).alias("cc_entries"),
            F.concat(F.lit("conv-"), F.expr("doc_id div 3").cast("string")).alias("conversation_id"),
            "carpeta", "attachments", "attachments_error",
            F.lit("text").alias("content_type"), F.col("text").alias("content"), F.lit("").alias("preview"),
            F.lit("acme").alias("empresa"), F.concat(src, F.lit("@example.com")).alias("cuenta"),
            F.lit("2024-02-01T00:00:00+00:00").alias("ingestado"), F.col("lang"))

    @cached_property
    def html(self) -> DataFrame:
        return self.table("pages").select(F.col("page_id").alias("id"), F.col("html").alias("body"))

    @cached_property
    def cues(self) -> DataFrame:
        return self.table("conversations").select(
            F.col("conv_id").alias("meeting"), F.col("turn").alias("pos"),
            F.col("role").alias("speaker"), "text")


# ---------------------------------------------------------------------------
# DuckDB twins (oracle only). Tables are the driver's pre-registered views.
# ---------------------------------------------------------------------------
_FOLDER_ROWS = ", ".join(f"('{i}', '{n}', '{p}')" for i, n, p in FOLDERS)

_FAILS = "((user_id % 7 = 3 AND day({ts}) BETWEEN 20 AND 23) OR k % 23 = 0)"
_INET = (f"CASE WHEN event_id % 11 = 0 OR {_FAILS.format(ts='ts')} THEN '' "
         "ELSE '<' || (k // 10) || '.' || strftime(ts, '%Y%m%d') || '.' || user_id || '@mail.example>' END")

SQL_VIEWS: dict[str, str] = {
    "v_events": """
        SELECT event_id, ts, user_id, event_type, value,
               CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
    "v_messages": f"""
        SELECT * FROM (
          SELECT user_id AS profile, 'm' || event_id AS id, {_INET} AS internet_id,
                 ts AS received, event_type AS folder_id, event_type AS subject,
                 event_id, user_id, k, 0 AS pos
          FROM v_events) b
        UNION ALL
        SELECT user_id, 'm' || event_id, {_INET}, ts, event_type, event_type, event_id, user_id, k, 1
        FROM v_events WHERE event_id % 5 = 0""",
    "v_folders": f"SELECT * FROM (VALUES {_FOLDER_ROWS}) t(folder_id, display_name, parent_id)",
    "v_tree": """
        SELECT * FROM v_folders
        UNION ALL SELECT 'r' || r_regionkey, r_name, 'root' FROM region
        UNION ALL SELECT 'n' || n_nationkey, n_name, 'r' || n_regionkey FROM nation
        UNION ALL SELECT 'c' || c_custkey, c_name, 'n' || c_nationkey FROM customer""",
    "v_first": "SELECT * FROM v_messages WHERE pos = 0",
    "v_index": "SELECT profile, id FROM v_first WHERE event_id % 7 = 0",
    "v_internet_index": "SELECT profile, internet_id FROM v_first WHERE event_id % 7 = 0 AND internet_id <> ''",
    "v_skip": "SELECT profile, id FROM v_first WHERE event_id % 97 = 0",
    "v_snapshot": """
        SELECT user_id AS profile, 'm' || event_id AS id, CASE WHEN event_id % 3 = 0 THEN 'inbox' ELSE event_type END AS folder_id
        FROM events WHERE event_id % 3 <> 1""",
    "v_fail": f"""
        SELECT profile, id, event_id % 3 AS prior_strikes FROM v_first WHERE {_FAILS.format(ts='received')}""",
    "v_run": "SELECT max(ts) AS run_at FROM events",
    "v_state": """
        SELECT profile, min(received) + to_days(CAST(3 + profile % 3 * 5 AS INTEGER)) AS marca
        FROM v_first WHERE profile % 3 < 2 GROUP BY profile""",
    "v_docs": """
        SELECT doc_id, 'd' || doc_id AS id, text AS subject, text AS body,
               lang AS folder_id, source AS profile FROM documents""",
    "v_html": "SELECT page_id AS id, html AS body FROM pages",
    "v_atts": """
        SELECT l_orderkey AS doc_id,
          list(struct_pack(name := 'pieza-' || l_partkey || '.pdf', content_type := 'application/pdf',
                           size := CAST(floor(l_extendedprice) AS BIGINT)) ORDER BY l_linenumber, 'pieza-' || l_partkey || '.pdf',
                           CAST(floor(l_extendedprice) AS BIGINT)) AS atts
        FROM lineitem GROUP BY l_orderkey""",
    "v_docmail": """
        SELECT d.doc_id, 'd' || d.doc_id AS id, '<d' || d.doc_id || '@docs>' AS internet_id, d.text AS subject,
          TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(d.doc_id * 7 AS BIGINT)) AS received,
          'Autor ' || d.source AS from_name, CASE WHEN d.doc_id % 6 = 0 THEN '' ELSE d.source || '@example.com' END AS from_address,
          'Buzón ' || d.source AS sender_name, 'buzon.' || d.source || '@example.com' AS sender_address,
          [struct_pack(name := 'Lector ' || d.lang, address := d.lang || '@example.com'),
           struct_pack(name := 'Autor ' || d.source, address := upper(d.source || '@example.com'))] AS to_list,
          CASE WHEN d.doc_id % 4 = 0 THEN [struct_pack(name := 'Copia', address := 'copia@example.com')]
               ELSE [] END AS cc_list,
          'conv-' || (d.doc_id // 3) AS conversation_id, coalesce(f.display_name, '') AS carpeta,
          CASE WHEN d.doc_id % 50 = 0 THEN [] ELSE coalesce(a.atts, []) END AS attachments,
          d.doc_id % 50 = 0 AS attachments_error, d.text AS body_text, 'acme' AS empresa,
          d.source || '@example.com' AS cuenta, '2024-02-01T00:00:00+00:00' AS ingestado, d.lang
        FROM documents d LEFT JOIN v_atts a USING (doc_id) LEFT JOIN v_folders f ON f.folder_id = d.lang""",
    "v_cues": "SELECT conv_id AS meeting, turn AS pos, role AS speaker, text FROM conversations",
    "v_timed": f"""
        SELECT 'timed' AS calendar, user_id AS profile, 'e' || event_id AS id, event_id,
          upper(left(event_type, 1)) || lower(substr(event_type, 2)) AS subject,
          CASE WHEN event_id % 10 = 0 THEN date_trunc('day', ts) ELSE ts END AS start_ts,
          CASE WHEN event_id % 10 = 0 THEN date_trunc('day', ts) + to_days(CAST(1 + event_id % 3 AS INTEGER))
               ELSE ts + to_minutes(CAST(floor(value) AS BIGINT)) END AS end_ts,
          event_id % 10 = 0 AS all_day, event_id % 13 = 0 AS cancelled,
          CASE WHEN event_type IN ('click', 'purchase') THEN 'https://teams.microsoft.com/l/meetup-join/' || event_id
               WHEN event_type = 'view' THEN 'https://meet.example.com/j/' || event_id ELSE '' END AS join_url,
          event_type = 'click' AS is_online,
          CASE WHEN event_type = 'purchase' THEN 'teamsForBusiness' ELSE 'unknown' END AS provider,
          'Usuario ' || user_id AS org_name, 'u' || user_id || '@example.com' AS org_address,
          [struct_pack(type := 'required', name := 'Usuario ' || (user_id + 1), address := 'u' || (user_id + 1) || '@example.com'),
           struct_pack(type := 'optional', name := 'Usuario ' || (user_id + 7), address := 'u' || (user_id + 7) || '@example.com'),
           struct_pack(type := 'required', name := 'Usuario ' || user_id, address := upper('u' || user_id || '@example.com'))]
          || CASE WHEN event_id % 4 = 0 THEN [struct_pack(type := 'resource', name := 'Sala ' || (event_id % 4),
                                                          address := 'sala' || (event_id % 4) || '@example.com')]
                  ELSE [] END AS attendees,
          CASE WHEN event_id % 3 = 0 THEN 'Sala ' || (event_id % 4) ELSE '' END AS location
        FROM events""",
    "v_span_att": """
        SELECT l_orderkey AS o_orderkey,
          list(struct_pack(type := CASE WHEN l_suppkey % 5 = 0 THEN 'resource' ELSE 'required' END,
                           name := s_name, address := lower(replace(s_name, '#', '.')) || '@example.com')
               ORDER BY l_linenumber, l_suppkey, l_partkey) AS attendees
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey""",
    "v_online": """
        SELECT join_url, 'om' || (event_id // 2) AS meeting_id FROM v_timed
        WHERE contains(join_url, 'teams.microsoft') AND event_id % 6 <> 0
        UNION ALL
        SELECT join_url, 'omx' || event_id FROM v_timed
        WHERE contains(join_url, 'teams.microsoft') AND event_id % 6 <> 0 AND event_id % 8 = 0""",
    "v_transcripts": """
        SELECT 'om' || meeting AS meeting_id, 't' || meeting AS transcript_id,
          TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(meeting AS BIGINT)) AS created,
          meeting % 7 <> 3 AS attributed,
          'WEBVTT' || chr(10) || chr(10) || string_agg(block, chr(10) || chr(10) ORDER BY pos) AS vtt
        FROM (
          SELECT meeting, pos,
            CAST(pos + 1 AS VARCHAR) || chr(10) ||
            CASE WHEN pos % 3 = 0 THEN CAST(pos * 7 // 3600 AS VARCHAR) || ':' || lpad(CAST((pos * 7 // 60) % 60 AS VARCHAR), 2, '0')
                                      || ':' || lpad(CAST(pos * 7 % 60 AS VARCHAR), 2, '0') || '.000'
                 WHEN pos % 3 = 1 THEN lpad(CAST((pos * 7 // 60) % 60 AS VARCHAR), 2, '0') || ':'
                                      || lpad(CAST(pos * 7 % 60 AS VARCHAR), 2, '0') || ',000'
                 ELSE lpad(CAST(pos * 7 // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST((pos * 7 // 60) % 60 AS VARCHAR), 2, '0')
                      || ':' || lpad(CAST(pos * 7 % 60 AS VARCHAR), 2, '0') || '.000' END
            || ' --> ' || lpad(CAST((pos * 7 + 5) // 3600 AS VARCHAR), 2, '0') || ':'
            || lpad(CAST(((pos * 7 + 5) // 60) % 60 AS VARCHAR), 2, '0') || ':'
            || lpad(CAST((pos * 7 + 5) % 60 AS VARCHAR), 2, '0') || '.000' || chr(10) ||
            CASE WHEN speaker = 'user' THEN '<v Ana Pérez>' || text || '</v>'
                 WHEN speaker = 'assistant' THEN '<v.loud Asistente Virtual>' || text || '</v>'
                 ELSE text END AS block
          FROM v_cues) GROUP BY meeting""",
    "v_seen_transcripts": """
        SELECT DISTINCT profile, 't' || (event_id // 2) AS transcript_id FROM v_timed
        WHERE contains(join_url, 'teams.microsoft') AND event_id % 6 <> 0 AND (event_id // 2) % 5 = 0""",
    "v_refusals": """
        SELECT DISTINCT join_url, CASE WHEN event_id % 2 = 0 THEN 'Graph 403 Forbidden'
                                       ELSE 'Graph 403 GraphAccessToTranscriptsDisabled' END AS motive
        FROM v_timed WHERE event_id % 17 = 0 AND join_url <> ''""",
    "v_spans": f"""
        SELECT 'spans' AS calendar, o_custkey // {CUSTOMERS_PER_CALENDAR} AS profile, 'o' || o_orderkey AS id,
          o_orderkey AS event_id, 'Pedido ' || o_orderkey AS subject, o_orderdate AS start_ts,
          o_orderdate + to_days(CAST(o_orderkey % 70 AS INTEGER)) AS end_ts, o_orderkey % 2 = 0 AS all_day,
          o_orderstatus = 'F' AS cancelled, '' AS join_url, false AS is_online, '' AS provider,
          c_name AS org_name, lower(replace(c_name, '#', '.')) || '@example.com' AS org_address,
          coalesce(a.attendees, []) AS attendees, '' AS location
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN v_span_att a USING (o_orderkey)""",
}

# Which views each view reads (to emit CTEs in dependency order).
SQL_DEPS: dict[str, list[str]] = {
    "v_messages": ["v_events"], "v_tree": ["v_folders"], "v_first": ["v_messages"],
    "v_index": ["v_first"], "v_internet_index": ["v_first"], "v_skip": ["v_first"],
    "v_fail": ["v_first"], "v_state": ["v_first"], "v_spans": ["v_span_att"], "v_docmail": ["v_atts", "v_folders"],
    "v_online": ["v_timed"], "v_transcripts": ["v_cues"], "v_seen_transcripts": ["v_timed"], "v_refusals": ["v_timed"],
}


def sql_with(body: str, *views: str, extra: dict[str, str] | None = None,
             extra_deps: dict[str, list[str]] | None = None) -> str:
    """``WITH`` the needed views (and their dependencies), then ``body``.

    ``extra`` adds query-local CTEs, emitted after the shared views in the
    given order."""
    extra = extra or {}
    deps = dict(SQL_DEPS)
    deps.update(extra_deps or {})
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in deps.get(name, []):
            visit(dep)
        order.append(name)

    for v in views:
        visit(v)
    for name in extra:
        visit(name)
    defs = {**SQL_VIEWS, **extra}
    ctes = ",\n".join(f"{name} AS ({defs[name]})" for name in order)
    return f"WITH {ctes}\n{body}" if ctes else body
