"""Calendar days.

Events are expanded onto the local days they touch with
``explode(sequence(first, last))``. An agenda's shuffle does not move event-days:
an event is sent once to each stretch of ``STRETCH_DAYS`` days it touches, and runs
of days that have the same events are cut out of the stretch's ordered events
behind the shuffle (``day_runs``). Ordering and first-sighting are array work on a run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import people as P
from ..functions import text as X
from ..functions import times as TM

# --- fixed values (reference constants) -----------------------------------
TEAMS_PROVIDER = "teamsforbusiness"
TEAMS_HOST_TEXT = "teams.microsoft"
# --- days that share one group in the shuffle of ``day_runs`` -----------
STRETCH_DAYS = 32


def event_day_bounds(df: DataFrame, zone: str = TM.UTC, max_extra_days: int | None = None) -> DataFrame:
    """Add ``first_day``/``last_day``.

    All-day: dates taken literally, end exclusive. Timed: local start day to
    the local day of (end - 1 microsecond); a missing or backward end gives
    one day. ``max_extra_days`` caps an event at its first day and so many more.
    """
    start, end = F.col("start_ts"), F.col("end_ts")
    allday_first = F.to_date(start)
    allday_last = F.when(end.isNotNull() & (F.to_date(end) > allday_first),
                         F.date_sub(F.to_date(end), 1)).otherwise(allday_first)
    loc_start = TM.to_local(start, zone)
    timed_first = F.to_date(loc_start)
    timed_last = F.when(end.isNotNull() & (end > start),
                        F.to_date(TM.to_local(end, zone) - F.expr("INTERVAL 1 MICROSECOND"))).otherwise(timed_first)
    first = F.when(F.col("all_day"), allday_first).otherwise(timed_first)
    last = F.when(F.col("all_day"), allday_last).otherwise(timed_last)
    if max_extra_days is not None:
        last = F.least(last, F.date_add(first, max_extra_days))
    return (df.withColumn("first_day", F.when(start.isNotNull(), first))
            .withColumn("last_day", F.when(start.isNotNull(), last)))


def event_days(df: DataFrame, zone: str = TM.UTC, max_extra_days: int | None = None) -> DataFrame:
    """One row per (event, local day)."""
    b = event_day_bounds(df, zone, max_extra_days)
    return (b.filter(F.col("first_day").isNotNull())
            .withColumn("day", F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY")))))


def window_overlap(df: DataFrame, win_start: Column, win_end: Column) -> DataFrame:
    """Calendar-view window (F6): events overlapping [win_start, win_end)."""
    return df.filter((F.col("start_ts") < win_end) & (F.coalesce(F.col("end_ts"), F.col("start_ts")) > win_start))


def spine_ranges(events: DataFrame, keys: list[str]) -> DataFrame:
    """J12 as one range (``first_day``, ``last_day``) per key, from events with their own."""
    return (events.filter(F.col("first_day").isNotNull()).groupBy(*keys)
            .agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")))


def day_spine(days: DataFrame, keys: list[str]) -> DataFrame:
    """Every day from the first to the last event day per key (J12): the
    range is one small aggregate per key, expanded with ``sequence``."""
    rng = days.groupBy(*keys).agg(F.min("day").alias("d0"), F.max("day").alias("d1"))
    return rng.select(*keys, F.explode(F.sequence("d0", "d1", F.expr("INTERVAL 1 DAY"))).alias("day"))


def day_sort_key() -> Column:
    """L3: all-day first, then start, then id (null start first), as one
    fixed-width-prefix string: string order equals tuple order, and a flat
    string compares much faster than a struct inside ``array_sort``.

    Used as ``F.col("k")`` when ``with_sort_key`` already added it per event
    (before the day expansion), else computed here."""
    return F.concat(F.when(F.col("all_day"), F.lit("0")).otherwise(F.lit("1")),
                    F.coalesce(F.date_format("start_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(" " * 26)),
                    F.coalesce(F.col("id"), F.lit("")))


def with_sort_key(events: DataFrame) -> DataFrame:
    """Per-event L3 key, computed once instead of once per event day."""
    return events.withColumn("k", day_sort_key())


def _k(df: DataFrame) -> Column:
    return F.col("k") if "k" in df.columns else day_sort_key()


_RANGE = "struct<lo:date,hi:date,mark:boolean>"


def _stretch_start(number: Column) -> Column:
    return F.date_from_unix_date((number * STRETCH_DAYS).cast("int"))


def _stretches(ranges: DataFrame) -> DataFrame:
    """Each row once per stretch ``__s`` that its days touch; ``__r`` are its days of that stretch."""
    number = lambda c: F.floor(F.unix_date(F.col(c)) / STRETCH_DAYS)
    s = ranges.withColumn("__s", F.explode(F.sequence(number("first_day"), number("last_day"))))
    return s.withColumn("__r", F.struct(F.greatest("first_day", _stretch_start(F.col("__s"))).alias("lo"),
                                        F.least("last_day", F.date_sub(_stretch_start(F.col("__s") + 1), 1)).alias("hi")))


def day_runs(events: DataFrame, keys: list[str], fields: list[str], listed: DataFrame | None = None,
             mark: str | None = None) -> DataFrame:
    """One row per (keys, ``first_day``, ``last_day``): days in a row that have the same
    events, which are ``__e``, as structs of ``fields``, ordered by them. ``events`` carry
    ``first_day`` and ``last_day`` (``event_day_bounds``). The days are those that an event
    covers or, with ``listed`` (keys, first_day, last_day), all days of its ranges and no other;
    with ``mark``, a boolean column of ``listed``, a run's says whether a range with it has the run.

    What a day shows of its events is worked out once a run; ``each_day`` then gives its days.
    One shuffle, of a row per event and stretch: its size does not grow with
    the length of the events. A group is a stretch of one key, and holds at most
    ``STRETCH_DAYS`` times the largest of its days; runs end with their stretch."""
    e = _stretches(events.filter(F.col("first_day").isNotNull())).select(
        *keys, "__s", F.struct(*fields, "first_day", "last_day").alias("__event"), F.lit(None).cast(_RANGE).alias("__r"))
    if listed is not None:
        marked = F.col("__r").withField("mark", F.col(mark) if mark else F.lit(False))
        e = e.unionByName(_stretches(listed).select(*keys, "__s", marked.alias("__r")), allowMissingColumns=True)
    # dealt before the aggregate: the lists are made once, behind the shuffle
    g = (e.repartition(*keys, "__s").groupBy(*keys, "__s")
         .agg(F.sort_array(F.collect_list("__event")).alias("__g"), F.collect_set("__r").alias("__r")))
    if listed is None:
        g = g.withColumn("__r", F.array(F.struct(
            _stretch_start(F.col("__s")).alias("lo"), F.date_sub(_stretch_start(F.col("__s") + 1), 1).alias("hi"), F.lit(False).alias("mark"))))
    cut = lambda a, lo, hi: F.flatten(F.transform(a, lambda x: F.array(x[lo], F.date_add(x[hi], 1))))
    g = g.withColumn("__c", F.sort_array(F.array_distinct(F.concat(cut("__g", "first_day", "last_day"), cut("__r", "lo", "hi")))))
    between = F.transform(F.slice("__c", 1, F.size("__c") - 1), lambda lo, i: F.struct(
        lo.alias("first_day"), F.date_sub(F.get("__c", i + 1), 1).alias("last_day")))
    has = lambda r, x: (r["lo"] <= x["first_day"]) & (r["hi"] >= x["last_day"])
    asked = F.filter(between, lambda x: F.exists("__r", lambda r: has(r, x)))
    runs = F.transform(asked, lambda x: F.struct(
        x["first_day"].alias("first_day"), x["last_day"].alias("last_day"),
        *([F.exists("__r", lambda r: has(r, x) & r["mark"]).alias(mark)] if mark else []),
        F.filter("__g", lambda e: (e["first_day"] <= x["first_day"]) & (e["last_day"] >= x["last_day"])).alias("__e")))
    if listed is None:
        runs = F.filter(runs, lambda x: F.size(x["__e"]) > 0)
    return g.select(*keys, F.inline(runs))


def each_day(runs: DataFrame, where: Column | None = None) -> DataFrame:
    """Runs (``day_runs``) as one row a ``day``, all or those of runs ``where`` it holds."""
    days = F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))
    return runs.withColumn("day", F.explode(days if where is None else F.when(where, days))).drop("first_day", "last_day")


def day_groups(events: DataFrame, keys: list[str], fields: list[str], listed: DataFrame | None = None) -> DataFrame:
    """``day_runs`` with one row per (keys, day)."""
    return each_day(day_runs(events, keys, fields, listed)).select(*keys, "day", "__e")


def day_rollup(events: DataFrame, keys: list[str]) -> DataFrame:
    """A4: per day the event count and the ordered id list; ``events`` as in ``day_runs``.

    The L3 key is a fixed-width prefix followed by the id, so sorting by it
    orders the events, and the id is the key's tail: nothing else is carried."""
    width = 1 + 26
    g = day_runs(events.withColumn("k", _k(events)), keys, ["k"])
    r = g.select(*keys, "first_day", "last_day", F.size("__e").cast("bigint").alias("n_events"),
                 F.transform("__e", lambda e: F.substring(e["k"], width + 1, 1 << 20)).alias("ids"))
    return each_day(r).select(*keys, "day", "n_events", "ids")


def first_seen(labels: Column, emails: Column) -> Column:
    """A3 inside one day: labels in order, one per email (the first), without
    empty ones. Most days repeat nobody, which one hash pass shows. Both are
    columns, so that a long expression is not computed at each use."""
    seen = F.transform(labels, lambda x, i: F.struct(x.alias("label"), (F.array_position(emails, F.get(emails, i)) == i + 1)
                                                     .alias("first")))
    once = F.transform(F.filter(seen, lambda x: x["first"] & (x["label"] != "")), lambda x: x["label"])
    return F.when(F.size(F.array_distinct(emails)) == F.size(emails), F.filter(labels, lambda x: x != "")).otherwise(once)


def run_agenda(events: DataFrame, keys: list[str], carry: list[str] | None = None) -> DataFrame:
    """A3 + A4 in one shuffle: per run of days (``day_runs``) ``n_events``, ``ids``,
    ``people`` (participants of the ordered events, first seen wins) and an
    ordered array for each column of ``carry``.

    Needs ``people`` and ``people_keys`` (see ``with_people``), computed once
    per event before the day expansion.
    """
    carry = carry or []
    # the key comes first: it orders the events, whatever else is carried
    g = day_runs(events.withColumn("k", _k(events)), keys, ["k", "id", "people", "people_keys", *carry])
    part = lambda c: F.transform("__e", lambda e: e[c])
    g = g.withColumns({"__labels": F.flatten(part("people")), "__emails": F.flatten(part("people_keys"))})
    return g.select(*keys, "first_day", "last_day", F.size("__e").cast("bigint").alias("n_events"), part("id").alias("ids"),
                    first_seen(F.col("__labels"), F.col("__emails")).alias("people"),
                    *[part(c).alias(c) for c in carry])


def day_agenda(events: DataFrame, keys: list[str], carry: list[str] | None = None) -> DataFrame:
    """``run_agenda`` with one row per (keys, day)."""
    return each_day(run_agenda(events, keys, carry)).select(*keys, "day", "n_events", "ids", "people", *(carry or []))


def day_people(events: DataFrame, keys: list[str], shown: Callable[[Column], Column] = lambda people: people) -> DataFrame:
    """A3: participants of a day's ordered events, first seen wins, as they are or as
    ``shown`` makes of them, once a run of days."""
    r = run_agenda(events, keys).select(*keys, "first_day", "last_day", "people")
    r = r.select(*keys, "first_day", "last_day", F.size("people").alias("__n"), shown(F.col("people")).alias("people"))
    return each_day(r, F.col("__n") > 0).select(*keys, "day", "people")


def with_people(events: DataFrame) -> DataFrame:
    """A2: organizer-first participants without rooms, plus their email keys."""
    org = F.struct(F.struct(F.col("org_name").alias("name"), F.col("org_address").alias("address")).alias("emailAddress"))
    return with_sort_key(events.withColumn("__p", P.event_people_keyed(org, F.col("attendees"))).withColumns(
        {"people": F.col("__p.labels"), "people_keys": F.col("__p.keys")}).drop("__p"))


def attendee_cap(labels: Column, shown: int | None = None) -> Column:
    """All labels, or the first ``shown`` and then `` (+N more)``."""
    if shown is None:
        return F.array_join(labels, ", ")
    head = F.array_join(F.slice(labels, 1, shown), ", ")
    return F.when(F.size(labels) > shown,
                  F.concat(head, F.lit(" (+"), (F.size(labels) - shown).cast("string"), F.lit(" more)"))
                  ).otherwise(head)


def is_teams(join_url: Column, is_online: Column, provider: Column) -> Column:
    """F8: join URL present and (flag, or Teams provider, or Teams host)."""
    j = X.s(join_url)
    return (j != "") & (F.coalesce(is_online, F.lit(False))
                        | (F.lower(X.s(provider)) == TEAMS_PROVIDER)
                        | F.contains(j, F.lit(TEAMS_HOST_TEXT)))


def changed_days(new: DataFrame, old: DataFrame | None, keys: list[str]) -> DataFrame:
    """Days of ``new`` (rendered days with their ``content_hash``) whose
    hash differs from the stored one in ``old``, labelled ``new`` when nothing
    was stored. Without ``old``, ``new`` has the stored hashes itself, as ``stored_hash``."""
    if old is None:
        j = new.withColumnRenamed("stored_hash", "__old")
    else:
        j = new.join(old.select(*keys, "day", F.col("content_hash").alias("__old")), [*keys, "day"], "left")
    return (j.filter(~F.col("__old").eqNullSafe(F.col("content_hash")))
            .withColumn("change", F.when(F.col("__old").isNull(), F.lit("new")).otherwise(F.lit("changed"))).drop("__old"))
