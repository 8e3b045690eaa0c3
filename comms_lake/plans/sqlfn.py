"""DuckDB SQL twins of the column functions, for the oracle only.

Each builder returns a SQL expression string over the given SQL operands,
mirroring ``functions.text`` / ``functions.people`` rule for rule.
"""

from __future__ import annotations

from ..functions.people import NAME_EDGE_CLASS
from ..functions.text import WHITESPACE_CLASS as WS

EDGE = NAME_EDGE_CLASS.replace("'", "''")


def one_line(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{WS}+', ' ', 'g'))"


def normalize_email(x: str) -> str:
    return f"lower(trim(regexp_replace({one_line(x)}, '^[<>]+|[<>]+$', '', 'g')))"


def normalize_name(x: str) -> str:
    return (f"regexp_replace(regexp_replace(replace(replace({one_line(x)}, '<', ''), '>', ''), "
            f"'^{EDGE}+|{EDGE}+$', '', 'g'), ' {{2,}}', ' ', 'g')")


def person_label(name: str, address: str) -> str:
    e, n = normalize_email(address), normalize_name(name)
    return (f"(CASE WHEN {e} = '' THEN '' WHEN {n} = '' OR lower({n}) = {e} THEN '<' || {e} || '>' "
            f"ELSE {n} || ' <' || {e} || '>' END)")


def person_key(label: str) -> str:
    pat = f"<([^>]*)>{WS}*$"
    return (f"lower(trim(CASE WHEN regexp_matches({label}, '{pat}') "
            f"THEN regexp_extract({label}, '{pat}', 1) ELSE {label} END))")


def unique_people(lst: str, v: str = "x") -> str:
    """Ordered distinct by email key, first spelling wins, blanks dropped."""
    w = v + "w"
    return (f"list_filter({lst}, lambda {v}, {v}i: {v} <> '' AND NOT list_contains("
            f"list_transform(list_slice({lst}, 1, {v}i - 1), lambda {w}: {person_key(w)}), {person_key(v)}))")


def event_people(org_name: str, org_address: str, attendees: str) -> str:
    labels = (f"[{person_label(org_name, org_address)}] || list_transform(list_filter({attendees}, "
              f"lambda a: lower(coalesce(a.type, '')) <> 'resource'), lambda a: {person_label('a.name', 'a.address')})")
    return unique_people(labels, "p")


def event_place(location: str, attendees: str) -> str:
    """Location plus rooms not already contained in an earlier part."""
    rooms = (f"list_transform(list_filter({attendees}, lambda a: lower(coalesce(a.type, '')) = 'resource'), "
             f"lambda a: CASE WHEN {normalize_name('a.name')} <> '' THEN {normalize_name('a.name')} "
             f"ELSE {normalize_email('a.address')} END)")
    start = f"(CASE WHEN {one_line(location)} = '' THEN []::VARCHAR[] ELSE [{one_line(location)}] END)"
    step = ("lambda acc, r: CASE WHEN r = '' OR list_bool_or(list_transform(acc, "
            "lambda part: contains(lower(part), lower(r)))) THEN acc ELSE list_append(acc, r) END")
    return f"array_to_string(list_reduce({rooms}, {step}, {start}), '; ')"
