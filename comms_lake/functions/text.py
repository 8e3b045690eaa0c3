"""Text column expressions (slugs, hashes, quoting, whitespace, truncation).

All helpers take and return ``Column``s built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen. The single exception is
``ascii_fold`` (Unicode NFKD), which Spark has no built-in for; it is an
Arrow-batched pandas UDF.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values (must equal the reference's for identical output) -------
# Whitespace: Python's str.isspace() set, i.e. Unicode White_Space plus the
# four information separators U+001C..U+001F.
WHITESPACE_CLASS = (
    r"[\t\n\x{0b}\x{0c}\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}"
    r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
WHITESPACE = ("\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b)))
              + "\u2028\u2029\u202f\u205f\u3000")  # the class's members
# Device names a file stem may not take (con prn aux nul com1-9 lpt1-9).
RESERVED_NAMES = ["con", "prn", "aux", "nul"] + [f"com{i}" for i in range(1, 10)] + [
    f"lpt{i}" for i in range(1, 10)]
SLUG_MAX_CHARS = 60
SLUG_FALLBACK = "sin-asunto"
PLAIN_SLUG_FALLBACK = "unknown"
DIGEST_TRUNCATE_MARKER = "\n\n[...truncated]"
# Quote escapes beyond the short ones: C0 controls, DEL..U+009F, line and
# paragraph separators, BOM and the two non-characters U+FFFE/U+FFFF.
_LONG_ESCAPE_CODES = (
    [c for c in range(0x00, 0x20) if c not in (0x09, 0x0A, 0x0D)]
    + list(range(0x7F, 0xA0)) + [0x2028, 0x2029, 0xFEFF, 0xFFFE, 0xFFFF]
)
_NEEDS_LONG_ESCAPE = r"[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}\x{7f}-\x{9f}\x{2028}\x{2029}\x{feff}\x{fffe}\x{ffff}]"


def s(col) -> Column:
    """Null-safe string: null becomes ''."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def printable_ascii(c: Column) -> Column:
    """No character but ``space`` to ``~``: one range, which is a fast pass; unions of ranges are slow ones."""
    return ~c.rlike("[^ -~]")


def single_spaced(c: Column) -> Column:
    """Printable ASCII without spaces at its ends or next to each other."""
    space = F.lit(" ")
    return printable_ascii(c) & ~F.contains(c, F.lit("  ")) & ~F.startswith(c, space) & ~F.endswith(c, space)


def one_line(col) -> Column:
    """Collapse every Unicode whitespace run to one space and trim."""
    c = s(col)
    return F.when(single_spaced(c), c).otherwise(F.trim(F.regexp_replace(c, WHITESPACE_CLASS + "+", " ")))


def right_trim(col) -> Column:
    """Without the Unicode whitespace at the end."""
    return F.rtrim(col, F.lit(WHITESPACE))


def normalize_newlines(col) -> Column:
    """CRLF and lone CR to LF."""
    return F.regexp_replace(s(col), "\r\n?", "\n")


def neutralize_rules(col) -> Column:
    """A line that is ``---`` after trimming becomes ``\\---``."""
    return F.regexp_replace(
        s(col), "(?m)^" + WHITESPACE_CLASS.replace(r"\n", "") + "*---"
        + WHITESPACE_CLASS.replace(r"\n", "") + "*$", r"\\---")   # Java replacement: one literal backslash


def fence_text(col) -> Column:
    """Neutralize code fences; empty gives a placeholder."""
    c = s(col)
    return F.when(c == "", F.lit("_(empty)_")).otherwise(F.replace(c, F.lit("```"), F.lit("` ` `")))


def truncated_marker(max_bytes: int) -> str:
    """What a cut body ends with."""
    return f"[...truncado a {max_bytes // 1024} KB]"


def truncate_chars(col, limit: int | None = None, marker: str = DIGEST_TRUNCATE_MARKER) -> Column:
    """Digest excerpt: fences neutralized, ``limit`` characters plus marker
    (X9), or the whole body."""
    c = s(col)
    cleaned = F.replace(c, F.lit("```"), F.lit("` ` `"))
    if limit is None:
        return F.when(c == "", F.lit("_(body unavailable)_")).otherwise(cleaned)
    return (F.when(c == "", F.lit("_(body unavailable)_"))
            .when(F.char_length(cleaned) <= limit, cleaned)
            .otherwise(F.concat(F.substring(cleaned, 1, limit), F.lit(marker))))


def utf8_bytes(col) -> Column:
    return F.octet_length(s(col))


def truncate_utf8(col, max_bytes: int) -> Column:
    """Longest prefix that fits in ``max_bytes`` UTF-8 bytes.

    Cuts the encoded bytes before the character that the limit would split:
    at most three continuation bytes (10xxxxxx) lie before its first byte.
    """
    c = s(col)
    raw = F.encode(c, "UTF-8")
    byte = lambda at: F.conv(F.hex(F.substring(raw, at, 1)), 16, 10).cast("int")
    cut = F.lit(0)
    for back in (3, 2, 1, 0):  # the byte after the cut must begin a character
        at = F.lit(max_bytes - back)
        cut = F.when((at >= 0) & (F.shiftright(byte(at + 1), 6) != 2), at).otherwise(cut)
    return F.when(F.octet_length(c) <= max_bytes, c).otherwise(F.decode(F.substring(raw, F.lit(1), cut), "UTF-8"))


def sha_hex(col, n: int) -> Column:
    """First ``n`` hex digits of SHA-1 over UTF-8."""
    return F.substring(F.sha1(F.encode(s(col), "UTF-8")), 1, n)


@F.pandas_udf(T.StringType())
def ascii_fold(values: pd.Series) -> pd.Series:
    """NFKD then drop non-ASCII (X1's first step)."""
    return values.map(
        lambda v: None if v is None else
        unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode("ascii"))


def _cut_at_dash(text: Column, max_chars: int) -> Column:
    """First ``max_chars`` characters, cut back to the last dash when that
    dash lies in the second half, then stripped of edge dashes."""
    cut = F.left(text, F.lit(max_chars))
    back = F.locate("-", F.reverse(cut))
    last_dash = F.char_length(cut) - back + 1  # 1-based, valid when back > 0
    keep = F.when((back > 0) & (last_dash >= max_chars // 2 + 1), last_dash - 1).otherwise(
        F.char_length(cut))
    return F.regexp_replace(F.left(cut, keep), "^-+|-+$", "")


def _slug_tail(dashed: Column, fallback: str, max_chars: int | None) -> Column:
    text = F.regexp_replace(dashed, "^-+|-+$", "")
    if max_chars is not None:
        text = F.when(F.char_length(text) > max_chars, _cut_at_dash(text, max_chars)).otherwise(text)
    text = F.when(text == "", F.lit(fallback)).otherwise(text)
    return F.when(text.isin(RESERVED_NAMES), F.concat(F.lit("item-"), text)).otherwise(text)


def slug_ascii(col, fallback: str = SLUG_FALLBACK, max_chars: int = SLUG_MAX_CHARS) -> Column:
    """Accent-folding slug for document names."""
    folded = F.lower(ascii_fold(s(col)))
    return _slug_tail(F.regexp_replace(folded, "[^a-z0-9]+", "-"), fallback, max_chars)


def slug_plain(col, fallback: str = PLAIN_SLUG_FALLBACK) -> Column:
    """Digest slug: lower, every non ``[a-z0-9]`` run to a dash."""
    return _slug_tail(F.regexp_replace(F.lower(s(col)), "[^a-z0-9]+", "-"), fallback, None)


def yaml_quote(col) -> Column:
    """Double-quoted scalar that is also a JSON string."""
    plain = s(col)
    c = F.replace(plain, F.lit("\\"), F.lit("\\\\"))
    c = F.replace(c, F.lit('"'), F.lit('\\"'))
    c = F.replace(c, F.lit("\n"), F.lit("\\n"))
    c = F.replace(c, F.lit("\r"), F.lit("\\r"))
    c = F.replace(c, F.lit("\t"), F.lit("\\t"))
    slow = c
    for code in _LONG_ESCAPE_CODES:
        slow = F.replace(slow, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    needs_none = printable_ascii(plain) & ~F.contains(plain, F.lit('"')) & ~F.contains(plain, F.lit("\\"))
    body = F.when(needs_none, plain).when(plain.rlike(_NEEDS_LONG_ESCAPE), slow).otherwise(c)
    return F.concat(F.lit('"'), body, F.lit('"'))


def yaml_escape(col) -> Column:
    """Digest scalar: quoted only when it holds a YAML-special character."""
    c = F.col(col) if isinstance(col, str) else col
    text = c.cast("string")
    quoted = F.concat(F.lit('"'), F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")),
                                            F.lit('"'), F.lit('\\"')), F.lit('"'))
    return (F.when(c.isNull(), F.lit("null"))
            .when(text.rlike("[:#\n\"'\\[\\]{}]"), quoted)
            .otherwise(text))


def yaml_list(key: str, items: Column) -> Column:
    """Frontmatter list block: ``key: []`` or ``key:`` plus quoted items."""
    values = F.filter(items, lambda v: v.isNotNull() & (v != ""))
    return F.when(F.size(values) == 0, F.lit(f"{key}: []")).otherwise(
        F.concat_ws("\n", F.lit(f"{key}:"),
                    F.concat_ws("\n", F.transform(values, lambda v: F.concat(F.lit("  - "), yaml_quote(v))))))


def size_label(col) -> Column:
    """``max(1, round(bytes/1024)) KB``, half-even like Python."""
    c = F.col(col) if isinstance(col, str) else col
    kb = F.greatest(F.lit(1), F.bround(c.cast("double") / 1024.0, 0).cast("bigint"))
    return F.when(c.isNull(), F.lit("tamaño desconocido")).otherwise(
        F.concat(kb.cast("string"), F.lit(" KB")))


def fit_path_stem(directory: Column, stem: Column, suffix: str, max_chars: int = 240) -> Column:
    """Shorten a stem so ``directory/stem+suffix`` fits in ``max_chars``."""
    full_len = F.char_length(directory) + 1 + F.char_length(stem) + len(suffix)
    excess = full_len - max_chars
    keep = F.greatest(F.lit(12), F.char_length(stem) - excess - 7)
    short = F.concat(F.regexp_replace(F.left(stem, keep), "-+$", ""), F.lit("-"), sha_hex(stem, 6))
    return F.when(full_len <= max_chars, stem).otherwise(short)


def fit_path_slug(parent: Column, slug: Column, filename: Column, max_chars: int = 240) -> Column:
    """Shorten a folder name so that ``parent/slug/filename`` fits in
    ``max_chars``: its beginning and eight hex digits of its hash (X18, digests)."""
    over = F.char_length(parent) + F.char_length(slug) + F.char_length(filename) + 2 - max_chars
    head = F.left(slug, F.greatest(F.lit(8), F.char_length(slug) - over - 9))
    return F.when(over <= 0, slug).otherwise(F.concat(F.regexp_replace(head, "-+$", ""), F.lit("-"), sha_hex(slug, 8)))
