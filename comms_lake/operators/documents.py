"""Immutable message documents.

A document is frontmatter (quoted scalars and lists) plus an attachments
section and the body, rendered per row with ``concat_ws`` (null parts are
skipped, so optional lines are ``when(...)`` without ``otherwise``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import people as P
from ..functions import text as X
from ..functions import times as TM
from ..functions.html import strip_markup, tidy_text
from ..functions.vtt import html_unescape

# --- fixed values (reference labels) ---------------------------------------
NO_NAME = "(sin nombre)"
UNKNOWN_KIND = "tipo desconocido"
ATTACHMENTS_FAILED = "- (no se pudo leer la lista de adjuntos)"


def with_body_text(df: DataFrame) -> DataFrame:
    """HTML bodies to text, empty bodies fall back to the preview,
    newlines normalized. One pass: the markup rewrite runs on HTML rows only
    (plain rows hand the decoder a null)."""
    is_html = F.lower(X.s("content_type")) == "html"
    decoded = html_unescape(F.when(is_html, strip_markup("content")))
    text = F.when(is_html, tidy_text(decoded)).otherwise(X.s("content"))
    body = F.when(F.trim(F.regexp_replace(text, X.WHITESPACE_CLASS, " ")) == "", X.s("preview")).otherwise(text)
    return df.withColumn("body_text", X.normalize_newlines(body))


def with_folder_name(messages: DataFrame, folders: DataFrame, key: str = "folder_id") -> DataFrame:
    """The display name of each message's folder as ``carpeta`` ('' where the folder is unknown)."""
    names = folders.select(F.col("folder_id").alias(key), F.col("display_name").alias("__name")).dropDuplicates([key])
    return messages.join(names, key, "left").withColumn("carpeta", F.coalesce("__name", F.lit(""))).drop("__name")


def with_attachments(messages: DataFrame, attachments: DataFrame, failed: Column, key: str = "id") -> DataFrame:
    """J7 + S5: each message's attachments (``attachments``: key, pos, name,
    content_type, size) as an array in ``pos`` order; a message whose listing
    ``failed`` has none and says so. A group is one message's attachments."""
    item = F.struct("pos", "name", "content_type", "size")
    lists = (attachments.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("__a"))
             .withColumn("__a", F.transform("__a", lambda x: F.struct(x["name"].alias("name"), x["content_type"].alias("content_type"),
                                                                      x["size"].alias("size")))))
    none = F.array().cast("array<struct<name:string,content_type:string,size:bigint>>")
    return messages.join(lists, key, "left").withColumns({
        "attachments": F.when(failed, none).otherwise(F.coalesce("__a", none)), "attachments_error": failed}).drop("__a")


def attachment_lines(atts: Column) -> Column:
    """A5 + X19: ``- name (kind, N KB)`` per attachment."""
    return F.transform(atts, lambda a: F.concat(
        F.lit("- "), F.when(X.one_line(a["name"]) == "", F.lit(NO_NAME)).otherwise(X.one_line(a["name"])),
        F.lit(" ("), F.when(X.one_line(a["content_type"]) == "", F.lit(UNKNOWN_KIND)).otherwise(X.one_line(a["content_type"])),
        F.lit(", "), X.size_label(a["size"]), F.lit(")")))


def render_mail(df: DataFrame, zone: str = TM.UTC, max_bytes: int | None = None) -> DataFrame:
    """The message document in column ``content``; ``max_bytes`` cuts the
    body (X8) and says so.

    Expects id, internet_id, subject, received (UTC NTZ), from_entry,
    sender_entry, to_entries, cc_entries, conversation_id, carpeta,
    attachments (ordered array of name/content_type/size), attachments_error,
    body_text, empresa, cuenta, ingestado.
    """
    sender = F.when(P.person_of(F.col("from_entry")) != "", P.person_of(F.col("from_entry"))).otherwise(
        P.person_of(F.col("sender_entry")))
    people = P.unique_people(F.concat(
        F.array(sender), F.transform(F.coalesce("to_entries", F.array()), P.person_of),
        F.transform(F.coalesce("cc_entries", F.array()), P.person_of)))
    names = F.transform(F.coalesce("attachments", F.array()), lambda a: F.when(
        X.one_line(a["name"]) == "", F.lit(NO_NAME)).otherwise(X.one_line(a["name"])))
    fecha = TM.local_iso("received", zone)
    has_atts = F.size(F.coalesce("attachments", F.array())) > 0
    err = F.coalesce(F.col("attachments_error"), F.lit(False))
    body = X.neutralize_rules(F.regexp_replace(F.col("body_text"), "^\n+|\n+$", ""))
    cut = body if max_bytes is None else X.truncate_utf8(body, max_bytes)
    truncated = F.lit(False) if max_bytes is None else X.utf8_bytes(body) > max_bytes
    text = F.regexp_replace(cut, X.WHITESPACE_CLASS + "+$", "")
    att_block = (F.when(has_atts, F.concat_ws("\n", F.lit("## Adjuntos"), F.lit(""),
                                              F.array_join(attachment_lines(F.col("attachments")), "\n"), F.lit("")))
                 .when(err, F.concat_ws("\n", F.lit("## Adjuntos"), F.lit(""), F.lit(ATTACHMENTS_FAILED), F.lit(""))))
    doc = F.concat_ws(
        "\n",
        F.lit("---"), F.lit("fuente: correo"),
        F.concat(F.lit("empresa: "), X.yaml_quote("empresa")),
        F.concat(F.lit("cuenta: "), X.yaml_quote("cuenta")),
        F.concat(F.lit("fecha: "), fecha),
        F.concat(F.lit("creationDate: "), F.left(fecha, F.lit(10))),
        F.concat(F.lit("id_origen: "), X.yaml_quote("id")),
        F.concat(F.lit("id_internet: "), X.yaml_quote("internet_id")),
        X.yaml_list("participantes", people),
        F.concat(F.lit("asunto: "), X.yaml_quote("subject")),
        F.lit("proyecto:"),
        F.concat(F.lit("carpeta: "), X.yaml_quote("carpeta")),
        F.concat(F.lit("hilo: "), X.yaml_quote("conversation_id")),
        X.yaml_list("adjuntos", names),
        F.when(err, F.lit("adjuntos_error: true")),
        F.concat(F.lit("ingestado: "), F.col("ingestado")),
        F.lit("---"), F.lit(""),
        att_block,
        F.lit("## Cuerpo"), F.lit(""), text,
        F.when(truncated, F.concat(F.lit("\n"), F.lit(X.truncated_marker(max_bytes or 0)))))
    return df.withColumn("content", F.concat(F.regexp_replace(doc, "\n+$", ""), F.lit("\n")))


def parse_frontmatter(df: DataFrame, content_col: str = "content", max_lines: int | None = None) -> DataFrame:
    """(key, value, items) rows of the frontmatter; quoted scalars are
    JSON strings; ``items`` holds the values of a list's ``- `` lines.
    ``max_lines`` bounds the header."""
    lines = F.split(F.col(content_col), "\n")
    head = F.slice(lines, 2, max_lines if max_lines is not None else F.size(lines))
    end = F.array_position(F.transform(head, lambda x: F.trim(x) == "---"), True).cast("int")
    ok = (F.trim(F.element_at(lines, 1)) == "---")
    body = F.when(ok & (end > 0), F.slice(head, 1, end - 1))

    def scalar(raw: Column) -> Column:
        decoded = F.from_json(F.concat(F.lit('{"v":'), raw, F.lit("}")), "v string")["v"]
        return F.when(raw.startswith('"'), F.coalesce(decoded, F.regexp_replace(raw, '^"+|"+$', ""))).otherwise(raw)
    e = df.select("*", F.posexplode(body).alias("line_no", "line"), body.alias("__head"))
    e = e.filter(F.col("line").rlike("^[A-Za-z_][A-Za-z0-9_]*:"))
    key = F.regexp_extract("line", "^([A-Za-z_][A-Za-z0-9_]*):", 1)
    raw = F.trim(F.regexp_replace("line", "^[A-Za-z_][A-Za-z0-9_]*:", ""))
    # a list's items are the "- " lines up to the next other line, read as one JSON array
    rest = F.slice("__head", F.col("line_no") + 2, F.size("__head"))
    stop = F.array_position(F.transform(rest, lambda x: ~x.rlike("^\\s*- ")), True).cast("int")
    own = F.transform(F.when(stop > 0, F.slice(rest, 1, stop - 1)).otherwise(rest),
                      lambda x: F.trim(F.regexp_replace(x, "^\\s*- ", "")))
    plain = lambda x: F.concat(F.lit('"'), F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")),
                                                     F.lit('"'), F.lit('\\"')), F.lit('"'))
    array = F.array_join(F.transform(own, lambda x: F.when(x.startswith('"'), x).otherwise(plain(x))), ",")
    items = F.from_json(F.concat(F.lit("["), array, F.lit("]")), "array<string>")
    return e.withColumns({"key": key, "value": scalar(raw), "items": items}).drop("__head")


# --- fixed values: day document labels -------------------------------------
ALL_DAY = "Todo el día"
NO_EVENTS = "Sin eventos."
NO_SUBJECT = "(sin asunto)"


def event_block(zone: str = TM.UTC) -> Column:
    """One event's block (computed once per event, before any day
    expansion). Needs subject, all_day, start_ts, end_ts, id, org_*,
    people, place, teams, cancelled, excerpt."""
    subject = F.when(X.one_line("subject") == "", F.lit(NO_SUBJECT)).otherwise(X.one_line("subject"))
    hm = lambda c: F.coalesce(F.substring(TM.wall(TM.to_local(F.col(c), zone)), 12, 5), F.lit("??:??"))
    header = F.when(F.col("all_day"), F.concat(F.lit(f"## {ALL_DAY} · "), subject)).otherwise(
        F.concat(F.lit("## "), hm("start_ts"), F.lit("–"), hm("end_ts"), F.lit(" · "), subject))
    org = P.person_label(F.col("org_name"), F.col("org_address"))
    lines = [header,
             F.concat(F.lit("- id_origen: "), X.one_line("id")),
             F.concat(F.lit("- organizador: "), org),
             F.concat(F.lit("- participantes: "), F.array_join("people", "; ")),
             F.concat(F.lit("- lugar: "), F.col("place")),
             F.concat(F.lit("- teams: "), F.when(F.col("teams"), F.lit("sí")).otherwise(F.lit("no"))),
             F.when(F.col("cancelled"), F.lit("- estado: cancelado")),
             F.when(F.col("excerpt") != "", F.concat(F.lit("- resumen: "), F.col("excerpt")))]
    return F.concat_ws("\n", *[X.right_trim(x) for x in lines])


# what a day document shows of an event; the L3 key comes first and orders them
DAY_ENTRY = ["k", "id", "block", "people", "people_keys"]


def _entry_lines(events: DataFrame) -> DataFrame:
    """``id`` and ``people`` as the lines that stand for them in a day's lists: quoted once an event, not at each day."""
    line = lambda v: F.when(v != "", F.concat(F.lit("  - "), X.yaml_quote(v)))
    return events.withColumns({"id": F.when(F.col("id") == "", F.lit("")).otherwise(line(F.col("id"))),
                               "people": F.transform("people", lambda v: F.coalesce(line(v), F.lit("")))})


def render_day(days: DataFrame, keys: list[str], ingestado: str, zone: str = TM.UTC) -> DataFrame:
    """X21 from rows: ``days`` has one row per (event, day) with ``k`` (L3 key),
    ``block``, ``people``, ``people_keys``; spine days arrive with a null id.
    See ``render_runs``."""
    # one shuffle: a spine row adds an empty entry to its day's group, and drops out of the array
    entry = F.when(F.col("id").isNotNull(), F.struct(*DAY_ENTRY))
    j = _entry_lines(days).groupBy(*keys, "day", "empresa", "cuenta").agg(F.sort_array(F.collect_list(entry)).alias("__e"))
    return render_runs(j.withColumns({"first_day": F.col("day"), "last_day": F.col("day")}), keys, ingestado, zone)


def render_ranges(events: DataFrame, listed: DataFrame, keys: list[str], ingestado: str, zone: str = TM.UTC,
                  stored: str | None = None, dealt: Callable[[DataFrame], DataFrame] = lambda runs: runs) -> DataFrame:
    """X21 from events with ``first_day`` and ``last_day``: the days of the
    ranges ``listed`` (see ``calendar.day_runs``), with or without events.

    With ``stored``, a boolean column of both, a day also has the ``stored_hash`` of
    an earlier snapshot, of the events with it alone, where a range with it has the day.
    ``dealt`` may deal the runs of days out anew before they become days."""
    from ..operators.calendar import day_runs
    entries = _entry_lines(events.filter(F.col("id").isNotNull()))
    runs = day_runs(entries, [*keys, "empresa", "cuenta"], DAY_ENTRY + ([stored] if stored else []), listed, stored)
    return render_runs(dealt(runs), keys, ingestado, zone, stored)


def _run_text(j: DataFrame, entries: Column, prefix: str) -> DataFrame:
    """What the days of a run share, of its ordered ``entries``: ``lists`` (ids, participants), ``n`` and ``body``."""
    from ..operators.calendar import first_seen
    part = lambda c: F.transform(F.col(f"{prefix}e"), lambda e: e[c])
    at = lambda c: F.col(f"{prefix}{c}")
    listing = lambda key, text: F.when(text == "", F.lit(f"{key}: []")).otherwise(F.concat(F.lit(f"{key}:\n"), text))
    j = j.withColumn(f"{prefix}e", entries)
    j = j.withColumns({f"{prefix}labels": F.flatten(part("people")), f"{prefix}emails": F.flatten(part("people_keys"))})
    # blank ids have no line
    j = j.withColumns({f"{prefix}ids": F.array_join(F.filter(part("id"), lambda v: v != ""), "\n"),
                       f"{prefix}people": F.array_join(first_seen(at("labels"), at("emails")), "\n")})
    body = F.when(F.size(at("e")) == 0, F.lit(NO_EVENTS)).otherwise(F.array_join(part("block"), "\n\n"))
    return j.withColumns({f"{prefix}lists": F.concat(listing("id_origen", at("ids")), F.lit("\n"), listing("participantes", at("people"))),
                          f"{prefix}n": F.size(at("e")).cast("string"),
                          f"{prefix}body": F.concat(F.regexp_replace(body, "\n+$", ""), F.lit("\n"))})


def render_runs(j: DataFrame, keys: list[str], ingestado: str, zone: str = TM.UTC, stored: str | None = None) -> DataFrame:
    """One day document per (keys, day): frontmatter with the ordered
    ids and participants, then the ordered event blocks (or ``Sin
    eventos.``). ``j`` has the ordered events (``DAY_ENTRY``) of a run of days as ``__e``;
    all but the date is worked out once a run.
    ``content_hash`` leaves the ingest line out, so it changes exactly when
    the day's text does (J13); ``stored`` as in ``render_ranges``."""
    from ..operators.calendar import each_day
    shared = ["__lists", "__n", "__body"]
    j = _run_text(j, F.col("__e"), "__")
    if stored:
        j = _run_text(j, F.filter("__e", lambda e: e[stored]), "__old_")
        shared += [stored, "__old_lists", "__old_n", "__old_body"]
    start = F.concat_ws("\n", F.lit("---"), F.lit("fuente: calendario"), F.concat(F.lit("empresa: "), X.yaml_quote("empresa")),
                        F.concat(F.lit("cuenta: "), X.yaml_quote("cuenta")), F.lit("fecha: "))
    done = each_day(j.select(*keys, "first_day", "last_day", start.alias("__start"), *shared))
    done = done.withColumn("__d", F.date_format("day", "yyyy-MM-dd"))
    d = F.col("__d")
    time = F.concat(d, F.lit("T00:00:00+00:00")) if zone == TM.UTC else TM.local_iso(F.to_timestamp_ntz(d), zone)

    def text(line: str, prefix: str = "__") -> Column:
        return F.concat(F.col("__start"), time, F.lit("\ncreationDate: "), d, F.lit("\n"), F.col(f"{prefix}lists"),
                        F.lit('\nasunto: "Agenda '), d, F.lit('"\nproyecto:\neventos: '), F.col(f"{prefix}n"),
                        F.lit(f"\n{line}\n---\n\n"), F.col(f"{prefix}body"))
    before = [F.when(F.col(stored), F.sha1(text("", "__old_"))).alias("stored_hash")] if stored else []
    return done.select(*keys, "day", text(f"ingestado: {ingestado}").alias("content"), F.sha1(text("")).alias("content_hash"), *before)


NO_TRANSCRIPT = "(transcripción vacía)"


def meeting_paths(rows: DataFrame, empresa: Column, zone: str = TM.UTC) -> DataFrame:
    """K3 + W6: ``reuniones/<empresa>/<date>-<slug>.md`` with the collision
    suffixes of ``collision_names`` by transcript id, fitted to the path
    limit (X18), and the VTT sidecar name next to it."""
    from .mail import collision_names
    d = rows.withColumn("dir", F.concat(F.lit("reuniones/"), empresa))
    stem = F.concat(F.date_format(TM.to_local("started", zone), "yyyy-MM-dd"), F.lit("-"), X.slug_ascii("subject", "reunion"))
    d = d.withColumn("stem", X.fit_path_stem(F.col("dir"), stem, ".md"))
    d = collision_names(d, ["started", "transcript_id"], "transcript_id")
    return d.withColumns({"path": F.concat(F.col("dir"), F.lit("/"), F.col("name"), F.lit(".md")),
                          "vtt_name": F.concat("name", F.lit(".vtt")),
                          "vtt_path": F.concat(F.col("dir"), F.lit("/"), F.col("name"), F.lit(".vtt"))})


def render_meeting(meetings: DataFrame, cue_lines: DataFrame, ingestado: str, zone: str = TM.UTC) -> DataFrame:
    """K3: the transcript document. ``meetings`` has transcript_id, started,
    subject, org_*, people, attributed, empresa, cuenta, vtt_name;
    ``cue_lines`` has transcript_id, block_pos, voice_pos, line (one
    transcript's cues are collected into its own document)."""
    lines = (cue_lines.groupBy("transcript_id")
             .agg(F.array_sort(F.collect_list(F.struct("block_pos", "voice_pos", "line"))).alias("__l")))
    j = meetings.join(lines, "transcript_id", "left")
    body = F.coalesce(F.array_join(F.transform("__l", lambda x: x["line"]), "\n"), F.lit(""))
    fecha = TM.local_iso("started", zone)
    doc = F.concat_ws(
        "\n", F.lit("---"), F.lit("fuente: reunion"),
        F.concat(F.lit("empresa: "), X.yaml_quote("empresa")), F.concat(F.lit("cuenta: "), X.yaml_quote("cuenta")),
        F.concat(F.lit("fecha: "), fecha), F.concat(F.lit("creationDate: "), F.left(fecha, F.lit(10))),
        F.concat(F.lit("id_origen: "), X.yaml_quote("transcript_id")),
        X.yaml_list("participantes", F.col("people")),
        F.concat(F.lit("asunto: "), X.yaml_quote("subject")), F.lit("proyecto:"),
        F.concat(F.lit("organizador: "), X.yaml_quote(P.person_label(F.col("org_name"), F.col("org_address")))),
        F.concat(F.lit("vtt: "), X.yaml_quote("vtt_name")),
        F.when(~F.col("attributed"), F.lit("hablantes: sin-atribucion")),
        F.lit(f"ingestado: {ingestado}"), F.lit("---"), F.lit(""), F.lit("## Transcripción"), F.lit(""),
        F.when(body == "", F.lit(NO_TRANSCRIPT)).otherwise(body))
    return j.withColumn("content", F.concat(F.regexp_replace(doc, "\n+$", ""), F.lit("\n")))
