"""Time expressions.

Source timestamps arrive either as ISO text (landed pages) or as zone-less
``TIMESTAMP_NTZ`` columns holding UTC wall time (the driver's tables). We
keep instants as UTC ``TIMESTAMP_NTZ`` so results never depend on the
session time zone, and render local time through an explicit ``zone`` job
parameter (the reference uses the machine zone implicitly).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import s

UTC = "UTC"


def parse_graph_ts(col) -> Column:
    """ISO text to UTC ``TIMESTAMP_NTZ``; naive text is UTC; bad or blank is
    null; fractions beyond 6 digits are cut (X13)."""
    text = F.trim(s(col))
    text = F.regexp_replace(text, "(\\.\\d{6})\\d+", "$1")
    zoned = text.rlike("([zZ]|[+-]\\d{2}:?\\d{2})$")
    as_instant = F.when(zoned, F.regexp_replace(text, "[zZ]$", "+00:00")).otherwise(
        F.concat(text, F.lit("+00:00")))
    ltz = as_instant.try_cast("timestamp")
    return F.when(text == "", F.lit(None)).otherwise(_ltz_to_utc_ntz(ltz))


def _ltz_to_utc_ntz(ltz: Column) -> Column:
    """Instant to its UTC wall time as NTZ: microseconds added to the epoch,
    so no session zone (or its DST gaps) takes part."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(ltz), epoch).cast("timestamp_ntz")


def to_local(ts_utc_ntz, zone: str = UTC) -> Column:
    """UTC wall time to wall time in ``zone`` (both NTZ)."""
    c = F.col(ts_utc_ntz) if isinstance(ts_utc_ntz, str) else ts_utc_ntz
    if zone == UTC:
        return c
    return F.convert_timezone(F.lit(UTC), F.lit(zone), c)


def offset_text(utc_ntz: Column, local_ntz: Column) -> Column:
    """``+HH:MM`` offset between local and UTC wall time."""
    minutes = F.timestamp_diff("MINUTE", utc_ntz, local_ntz)
    sign = F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+"))
    am = F.abs(minutes)
    return F.concat(sign, F.lpad((am / 60).cast("int").cast("string"), 2, "0"), F.lit(":"),
                    F.lpad((am % 60).cast("string"), 2, "0"))


def wall(ntz: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` of wall time. The text of the NTZ value itself:
    ``date_format`` would read it in the session zone, which may skip it."""
    return F.left(ntz.cast("timestamp_ntz").cast("string"), F.lit(19))


def iso_z(ts_utc_ntz) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ``."""
    c = F.col(ts_utc_ntz) if isinstance(ts_utc_ntz, str) else ts_utc_ntz
    return F.concat(F.replace(wall(c), F.lit(" "), F.lit("T")), F.lit("Z"))


def local_iso(ts_utc_ntz, zone: str = UTC) -> Column:
    """Local ISO time with offset, seconds precision."""
    c = F.col(ts_utc_ntz) if isinstance(ts_utc_ntz, str) else ts_utc_ntz
    loc = to_local(c, zone)
    return F.concat(F.replace(wall(loc), F.lit(" "), F.lit("T")),
                    offset_text(F.date_trunc("second", c), F.date_trunc("second", loc)))


def hhmm(ts_utc_ntz, zone: str = UTC) -> Column:
    c = F.col(ts_utc_ntz) if isinstance(ts_utc_ntz, str) else ts_utc_ntz
    return F.replace(F.substring(wall(to_local(c, zone)), 12, 5), F.lit(":"), F.lit(""))


def local_date(ts_utc_ntz, zone: str = UTC) -> Column:
    c = F.col(ts_utc_ntz) if isinstance(ts_utc_ntz, str) else ts_utc_ntz
    return F.to_date(to_local(c, zone))


def digest_local(ts_utc_ntz, zone: str = UTC, event_zone: Column | None = None) -> Column:
    """Digest rendering ``YYYY-MM-DD HH:MM`` (X15). A time whose own zone name
    (``event_zone``) is neither blank nor UTC is wall time already and is
    shown as it is."""
    c = F.col(ts_utc_ntz) if isinstance(ts_utc_ntz, str) else ts_utc_ntz
    local = to_local(c, zone)
    if event_zone is not None:
        local = F.when(F.lower(F.trim(s(event_zone))).isin("", "utc"), local).otherwise(c)
    return F.left(wall(local), F.lit(16))


def date_range_text(target_date: Column, days: Column) -> Column:
    """``start..end`` for a digest covering ``days`` days ending at target."""
    start = F.when(days <= 1, target_date).otherwise(F.date_sub(target_date, days - 1))
    return F.concat(F.date_format(start, "yyyy-MM-dd"), F.lit(".."),
                    F.date_format(target_date, "yyyy-MM-dd"))
