"""Readers and writers for landed records.

Landed data is files in a shared folder: paged JSON envelopes, JSON-lines
logs, the pipe-delimited run log, frontmatter documents, id indices and the
skip list. Readers always pass an explicit schema (no inference pass over
100 TB); a malformed JSON line lands in ``_corrupt_record`` instead of
failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import parse_graph_ts
from ..operators.ops import graph_time_hint
from ..session import bounded, materialize

ADDRESS = T.StructType([T.StructField("emailAddress", T.StructType([
    T.StructField("name", T.StringType()), T.StructField("address", T.StringType())]))])
ATTENDEE = T.StructType([T.StructField("type", T.StringType()),
                         T.StructField("status", T.StructType([T.StructField("response", T.StringType())])),
                         T.StructField("emailAddress", ADDRESS["emailAddress"].dataType)])
BODY = T.StructType([T.StructField("contentType", T.StringType()), T.StructField("content", T.StringType())])
MESSAGE = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("internetMessageId", T.StringType()),
    T.StructField("conversationId", T.StringType()), T.StructField("parentFolderId", T.StringType()),
    T.StructField("subject", T.StringType()), T.StructField("receivedDateTime", T.StringType()),
    T.StructField("from", ADDRESS), T.StructField("sender", ADDRESS),
    T.StructField("toRecipients", T.ArrayType(ADDRESS)), T.StructField("ccRecipients", T.ArrayType(ADDRESS)),
    T.StructField("hasAttachments", T.BooleanType()), T.StructField("body", BODY),
    T.StructField("bodyPreview", T.StringType())])
DATETIME_TZ = T.StructType([T.StructField("dateTime", T.StringType()), T.StructField("timeZone", T.StringType())])
EVENT = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("subject", T.StringType()),
    T.StructField("start", DATETIME_TZ), T.StructField("end", DATETIME_TZ),
    T.StructField("organizer", ADDRESS), T.StructField("attendees", T.ArrayType(ATTENDEE)),
    T.StructField("location", T.StructType([T.StructField("displayName", T.StringType())])),
    T.StructField("isAllDay", T.BooleanType()), T.StructField("isCancelled", T.BooleanType()),
    T.StructField("isOnlineMeeting", T.BooleanType()), T.StructField("onlineMeetingProvider", T.StringType()),
    T.StructField("onlineMeeting", T.StructType([T.StructField("joinUrl", T.StringType())])),
    T.StructField("body", BODY), T.StructField("bodyPreview", T.StringType())])


def page_schema(item: T.StructType) -> T.StructType:
    """Envelope of one landed page: items plus the continuation link; the
    landing step adds the scan id and page number."""
    return T.StructType([T.StructField("scan", T.StringType()), T.StructField("page", T.LongType()),
                         T.StructField("value", T.ArrayType(item)),
                         T.StructField("@odata.nextLink", T.StringType())])


def read_pages(spark: SparkSession, path: str, item: T.StructType) -> DataFrame:
    """Landed pages (JSON lines, one envelope per line)."""
    return spark.read.schema(page_schema(item)).json(path)


def page_items(pages: DataFrame) -> DataFrame:
    """Concatenate the ``value`` arrays of all pages (position kept)."""
    return pages.select("scan", "page", F.posexplode("value").alias("pos_in_page", "item"))


def _address(entry: Column) -> Column:
    """``name <email>`` when both are there, else whichever is."""
    n, a = F.coalesce(entry["emailAddress"]["name"], F.lit("")), F.coalesce(entry["emailAddress"]["address"], F.lit(""))
    return F.when((n != "") & (a != ""), F.concat(n, F.lit(" <"), a, F.lit(">"))).when(n != "", n).otherwise(a)


def _addresses(entries: Column) -> Column:
    return F.filter(F.transform(F.coalesce(entries, F.array()), _address), lambda x: x != "")


def _digest_body(item: Column, always: bool) -> Column:
    """X10, digest rule: an HTML body gives the preview (``always``: even an
    empty one), a text body itself or else the preview."""
    body, preview = F.coalesce(item["body"]["content"], F.lit("")), F.coalesce(item["bodyPreview"], F.lit(""))
    html = F.lower(F.coalesce(item["body"]["contentType"], F.lit(""))) == "html"
    shown = preview if always else F.when(preview != "", preview).otherwise(body)
    return F.when(html, shown).when(body != "", body).otherwise(preview)


def flatten_messages(items: DataFrame) -> DataFrame:
    """Landed MESSAGE objects (``page_items``) to flat rows. A missing id
    is '', an unreadable time null; such rows stay for the run to judge."""
    i = F.col("item")
    return items.select(
        "scan", F.coalesce(i["id"], F.lit("")).alias("id"), F.coalesce(i["internetMessageId"], F.lit("")).alias("internet_id"),
        F.coalesce(i["conversationId"], F.lit("")).alias("conversation_id"),
        F.coalesce(i["parentFolderId"], F.lit("")).alias("folder_id"), F.coalesce(i["subject"], F.lit("")).alias("subject"),
        parse_graph_ts(i["receivedDateTime"]).alias("received"), _address(i["from"]).alias("sender"),
        _addresses(i["toRecipients"]).alias("to"), _addresses(i["ccRecipients"]).alias("cc"),
        F.coalesce(i["hasAttachments"], F.lit(False)).alias("has_attachments"), _digest_body(i, False).alias("body_text"))


def flatten_events(items: DataFrame) -> DataFrame:
    """S3: landed EVENT objects to flat rows; a naive UTC time gets its ``Z``."""
    i = F.col("item")
    at = lambda c: graph_time_hint(i[c]["dateTime"], i[c]["timeZone"])
    return items.select(
        "scan", F.coalesce(i["id"], F.lit("")).alias("id"), F.coalesce(i["subject"], F.lit("")).alias("subject"),
        at("start").alias("start"), at("end").alias("end"), F.coalesce(i["start"]["timeZone"], F.lit("")).alias("timezone"),
        _address(i["organizer"]).alias("organizer"),
        _addresses(F.transform(F.coalesce(i["attendees"], F.array()), lambda a: F.struct(a["emailAddress"].alias("emailAddress"))))
        .alias("attendees"),
        F.coalesce(i["location"]["displayName"], F.lit("")).alias("location"),
        F.coalesce(i["onlineMeeting"]["joinUrl"], F.lit("")).alias("join_url"),
        F.coalesce(i["isCancelled"], F.lit(False)).alias("cancelled"),
        F.coalesce(i["isAllDay"], F.lit(False)).alias("all_day"), _digest_body(i, True).alias("body_text"))


def scan_caps(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Per scan, pages read (all, or those under the page budget) and
    whether the scan was cut (the last page read still had a continuation
    link)."""
    read = pages if max_pages is None else pages.filter(F.col("page") < max_pages)
    return read.groupBy("scan").agg(
        F.count("*").alias("pages_read"),
        F.sum(F.size("value")).alias("items_read"),
        F.max_by(F.col("`@odata.nextLink`").isNotNull(), F.col("page")).alias("capped"))


AUDIT = T.StructType([
    T.StructField("ts", T.StringType()), T.StructField("action", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("version", T.StringType()),
    T.StructField("summary", T.MapType(T.StringType(), T.StringType())),
    T.StructField("result_id", T.StringType()), T.StructField("error_code", T.StringType()),
    T.StructField("_corrupt_record", T.StringType())])


def read_json_log(spark: SparkSession, path: str, schema: T.StructType = AUDIT) -> DataFrame:
    """JSON-lines log with an open map part; bad lines are kept in
    ``_corrupt_record`` (PERMISSIVE mode)."""
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))


RUN_LOG_RE = (r"^(\S+) \| (.+?) \| correo (\d+) nuevos \| calendario (\d+) días \| "
              r"reuniones (\d+)(?: \((.*?)\))? \| estado (.*)$")


def run_log_line(r: DataFrame) -> Column:
    """K6: ``when | profile | correo N nuevos | calendario N días | reuniones
    N (note) | estado S; notes`` (no personal data)."""
    meet = F.concat(F.lit("reuniones "), F.col("reuniones").cast("string"),
                    F.when(F.col("reuniones_nota") != "", F.concat(F.lit(" ("), F.col("reuniones_nota"), F.lit(")")))
                    .otherwise(F.lit("")))
    estado = F.concat(F.lit("estado "), F.col("estado"),
                      F.when(F.size("notas") > 0, F.concat(F.lit("; "), F.array_join("notas", "; "))).otherwise(F.lit("")))
    return F.concat_ws(" | ", F.col("when"), F.coalesce(F.nullif(F.col("perfil"), F.lit("")), F.lit("-")),
                       F.concat(F.lit("correo "), F.col("correo_nuevos").cast("string"), F.lit(" nuevos")),
                       F.concat(F.lit("calendario "), F.col("calendario_dias").cast("string"), F.lit(" días")),
                       meet, estado)


def append_run_log(runs: DataFrame, path: str) -> None:
    """K6: one line a profile and run, added to the log; lines that are there stay."""
    runs.select(run_log_line(runs).alias("value")).write.mode("append").text(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Parse the pipe-delimited run log back into columns."""
    t = spark.read.text(path)
    g = {i: F.regexp_extract("value", RUN_LOG_RE, i) for i in range(1, 8)}
    estado_full = g[7]
    return t.select(
        g[1].alias("when"), g[2].alias("perfil"), g[3].cast("bigint").alias("correo_nuevos"),
        g[4].cast("bigint").alias("calendario_dias"), g[5].cast("bigint").alias("reuniones"),
        g[6].alias("reuniones_nota"),
        F.split(estado_full, "; ").getItem(0).alias("estado"),
        F.slice(F.split(estado_full, "; "), 2, 1 << 20).alias("notas"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited id index (blank lines ignored, distinct)."""
    return (spark.read.text(path).select(F.trim("value").alias("id"))
            .filter(F.col("id") != "").distinct())


def read_skip_list(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated skip list ``id, at, reason``."""
    return (spark.read.option("sep", "\t").schema("id string, at string, reason string").csv(path)
            .filter(F.col("id").isNotNull() & (F.col("id") != "")))


def append_documents(docs: DataFrame, path: str) -> DataFrame:
    """K1: append immutable documents, partitioned by month of the local day.

    Ids already stored are anti-joined away first, so re-running the same
    batch (or a replay after a crash) writes nothing new. A document's company
    and day never change, so the join keys include them and only the months of
    the batch are read (dynamic partition pruning). A month is a few files: a folder
    for each company and day, written by every task, would be a file for nearly every document."""
    spark = docs.sparkSession
    keys = ["empresa", "fecha_dia"]
    stored = spark.read.schema(T.StructType([*docs.schema.fields, T.StructField("fecha_mes", T.StringType())])).parquet
    docs = docs.withColumn("fecha_mes", F.substring("fecha_dia", 1, 7))
    if path_exists(spark, path):
        docs = materialize(docs, "batch-docs")
        touched = stored(path).select("id", *keys, "fecha_mes").join(
            bounded(materialize(docs.select("fecha_mes").distinct(), "batch-months")), "fecha_mes", "left_semi")
        docs = materialize(docs.join(touched, ["id", *keys], "left_anti"), "new-docs")
    docs.hint("rebalance", "fecha_mes").write.mode("append").partitionBy("fecha_mes").parquet(path)
    return stored(path).drop("fecha_mes")


def write_digests(digests: DataFrame, path: str) -> DataFrame:
    """K9: store digests (kind, target_date, path, content); a digest of the
    same kind, scope and date, and so of the same path, is overwritten. A
    touched (kind, date) partition is rewritten with its other documents."""
    spark = digests.sparkSession
    keys = ["kind", "target_date"]
    out = digests.select("kind", "target_date", "path", "content")
    if path_exists(spark, path):
        stored = spark.read.schema("path string, content string, kind string, target_date string").parquet(path)
        kept = stored.join(out.select(*keys).distinct(), keys, "left_semi").join(out.select(*keys, "path"), [*keys, "path"], "left_anti")
        out = materialize(out.unionByName(kept.select(*out.columns)), "digests")
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path))
    return spark.read.schema("path string, content string, kind string, target_date string").parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_payloads(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed digest payloads (one JSON document per line). A leading
    byte-order mark is stripped before parsing; a missing ``kind`` means
    mail; unparseable lines keep their raw text with null fields."""
    raw = spark.read.text(path).select(F.regexp_replace("value", "^\\uFEFF+", "").alias("raw"))
    parsed = raw.select("raw", F.from_json("raw", schema).alias("p"))
    return parsed.select("raw", "p.*").withColumn(
        "kind", F.coalesce(F.nullif(F.col("kind"), F.lit("")), F.lit("mail")))
