"""Participant expressions: email/name normalization, labels and ordered
distinct lists (X11, X12, A1, A2, F11, A6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITESPACE_CLASS, one_line, s, single_spaced

# --- fixed values: characters stripped from the edges of a display name ---
NAME_EDGE_CLASS = "[\"'`“”‘’«» ]"


def normalize_email(col) -> Column:
    """Trim, drop edge angle brackets, lowercase (X11)."""
    c = s(col)
    text = F.regexp_replace(one_line(c), "^[<>]+|[<>]+$", "")
    # nothing to trim or drop
    plain = single_spaced(c) & ~F.contains(c, F.lit("<")) & ~F.contains(c, F.lit(">"))
    return F.lower(F.when(plain, c).otherwise(F.trim(text)))


def normalize_name(col) -> Column:
    """No angle brackets, no edge quotes/spaces, whitespace collapsed (X11)."""
    c = s(col)
    text = F.replace(F.replace(one_line(c), F.lit("<"), F.lit("")), F.lit(">"), F.lit(""))
    text = F.regexp_replace(text, "^" + NAME_EDGE_CLASS + "+|" + NAME_EDGE_CLASS + "+$", "")
    # one_line left single spaces only; dropping brackets can make runs of them
    text = F.regexp_replace(text, " {2,}", " ")
    plain = single_spaced(c)
    for mark in "<>\"'`":  # the ASCII ones
        plain = plain & ~F.contains(c, F.lit(mark))
    return F.when(plain, c).otherwise(text)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: inside higher-order lambdas there is
    no common-subexpression elimination, so each use would re-run the regexes."""
    return F.transform(F.array(value), use)[0]


def _label(pair: Column) -> Column:
    email, nm = pair["e"], pair["n"]
    return (F.when(email == "", F.lit(""))
            .when((nm == "") | (F.lower(nm) == email), F.concat(F.lit("<"), email, F.lit(">")))
            .otherwise(F.concat(nm, F.lit(" <"), email, F.lit(">"))))


def _pair(name, address) -> Column:
    return F.struct(normalize_email(address).alias("e"), normalize_name(name).alias("n"))


def person_label(name, address) -> Column:
    """``Name <email>``, ``<email>`` or '' when there is no address."""
    return _bound(_pair(name, address), _label)


def person_of(entry: Column) -> Column:
    """Label of an ``{emailAddress:{name,address}}`` struct (null-safe)."""
    return person_label(entry["emailAddress"]["name"], entry["emailAddress"]["address"])


def person_key(label: Column) -> Column:
    """Email inside the trailing ``<...>``, else the text, lowercased."""
    inner = F.regexp_extract(label, "<([^>]*)>" + WHITESPACE_CLASS + "*$", 1)
    has = label.rlike("<([^>]*)>" + WHITESPACE_CLASS + "*$")
    return F.lower(F.trim(F.when(has, inner).otherwise(label)))


def keyed_person_of(entry: Column) -> Column:
    """(label, key) of an entry: ``person_of`` and its ``person_key``. An address without ``>``, as it
    stands between a label's brackets, is the key."""
    def keyed(pair):
        return F.struct(_label(pair).alias("label"), F.when(F.contains(pair["e"], F.lit(">")), person_key(_label(pair)))
                        .otherwise(pair["e"]).alias("key"))
    return _bound(_pair(entry["emailAddress"]["name"], entry["emailAddress"]["address"]), keyed)


def dedupe_keyed(items: Column, label: str = "label", key: str = "key", both: bool = False) -> Column:
    """Ordered distinct over an array of (label, key) structs: a left fold
    whose accumulator carries the keys seen so far (first one wins). The labels or,
    with ``both``, a struct of their ``keys`` and ``labels``."""
    init = F.struct(F.array().cast("array<string>").alias("keys"), F.array().cast("array<string>").alias("labels"))

    def step(acc, e):
        return F.when(e[label].isNull() | (e[label] == "") | F.array_contains(acc["keys"], e[key]), acc).otherwise(
            F.struct(F.concat(acc["keys"], F.array(e[key])).alias("keys"),
                     F.concat(acc["labels"], F.array(e[label])).alias("labels")))
    return F.aggregate(items, init, step, (lambda acc: acc) if both else (lambda acc: acc["labels"]))


def unique_people(labels: Column) -> Column:
    """Ordered distinct by email key, first spelling wins, blanks dropped (A1).

    One key per element, then a linear fold; a per-row operation on a
    bounded array (the recipients of one item), no shuffle involved.
    """
    keyed = F.transform(labels, lambda x: F.struct(x.alias("label"), person_key(x).alias("key")))
    return dedupe_keyed(keyed)


def is_resource(attendee: Column) -> Column:
    return F.lower(s(attendee["type"])) == "resource"


def event_people(organizer: Column, attendees: Column) -> Column:
    """Organizer first, then non-room attendees, ordered distinct."""
    return event_people_keyed(organizer, attendees)["labels"]


def event_people_keyed(organizer: Column, attendees: Column) -> Column:
    """``event_people`` as ``labels``, with their ``keys`` (``person_key``)."""
    others = F.filter(F.coalesce(attendees, F.array()), lambda a: ~is_resource(a))
    return dedupe_keyed(F.concat(F.array(keyed_person_of(organizer)), F.transform(others, keyed_person_of)), both=True)


def event_place(location_name: Column, attendees: Column) -> Column:
    """Location plus rooms not already contained in an earlier part."""
    place = one_line(location_name)
    rooms = F.transform(
        F.filter(F.coalesce(attendees, F.array()), is_resource),
        lambda a: _bound(normalize_name(a["emailAddress"]["name"]), lambda name: F.when(name != "", name).otherwise(
            normalize_email(a["emailAddress"]["address"]))))
    start = F.when(place == "", F.array().cast("array<string>")).otherwise(F.array(place))

    def step(acc, room):
        seen = F.exists(acc, lambda part: F.contains(F.lower(part), F.lower(room)))
        return F.when((room == "") | seen, acc).otherwise(F.concat(acc, F.array(room)))
    return F.array_join(F.aggregate(rooms, start, step), "; ")
