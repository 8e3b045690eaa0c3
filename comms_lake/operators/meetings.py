"""Past online meetings and their transcripts.

Candidates are filtered from the calendar scan; the join URL resolves to an
online-meeting id through a dimension (first id per URL); one event per
meeting id; transcripts not yet indexed and not older than the lookback.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .calendar import is_teams


def candidates(events: DataFrame, window_start: Column, now: Column) -> DataFrame:
    """F7 + F8: online, not cancelled, started in the lookback, already ended."""
    teams = is_teams(F.col("join_url"), F.col("is_online"), F.col("provider"))
    return events.filter(teams & ~F.coalesce(F.col("cancelled"), F.lit(False))
                         & F.col("start_ts").isNotNull() & (F.col("start_ts") >= window_start)
                         & (F.coalesce(F.col("end_ts"), F.col("start_ts")) <= now))


def resolve(online_meetings: DataFrame) -> DataFrame:
    """The first meeting id per join URL (explicit order: smallest id)."""
    return online_meetings.groupBy("join_url").agg(F.min("meeting_id").alias("meeting_id"))


def with_meeting_id(cands: DataFrame, online_meetings: DataFrame) -> DataFrame:
    """Left join on the join URL; unmatched rows keep a null id."""
    return cands.join(resolve(online_meetings), "join_url", "left")


def with_refusals(df: DataFrame, refusals: DataFrame) -> DataFrame:
    """The service's refusal (``motive``) per join URL, null where the meeting may be read."""
    return df.join(refusals.select("join_url", "motive").dropDuplicates(["join_url"]), "join_url", "left")


def first_event_per_meeting(df: DataFrame) -> DataFrame:
    """One event per profile and meeting id, the earliest (start, id); refused meetings are out."""
    w = Window.partitionBy("profile", "meeting_id").orderBy("start_ts", "id")
    if "motive" in df.columns:
        df = df.filter(F.col("motive").isNull())
    return (df.filter(F.col("meeting_id").isNotNull())
            .withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn"))


def new_transcripts(meetings: DataFrame, transcripts: DataFrame, seen: DataFrame,
                    window_start: Column) -> DataFrame:
    """J10 + F10: transcripts of a profile's meetings minus those in its
    index (``seen``: profile, transcript_id); created before the lookback is
    dropped, unknown creation time kept."""
    return (meetings.join(transcripts, "meeting_id")
            .join(seen, ["profile", "transcript_id"], "left_anti")
            .filter(F.col("created").isNull() | (F.col("created") >= window_start)))


def meeting_notes(with_ids: DataFrame) -> DataFrame:
    """Per profile the candidates, those without Teams data, and the
    run-log note: the first refusal's reason (in start order), then the
    number without data."""
    motive = F.col("motive") if "motive" in with_ids.columns else F.lit(None).cast("string")
    agg = with_ids.groupBy("profile").agg(
        F.count("*").alias("candidates"), F.count_if(motive.isNull() & F.col("meeting_id").isNull()).alias("unmatched"),
        F.min(F.when(motive.isNotNull(), F.struct("start_ts", "id", motive.alias("motive")))).alias("__first"))
    refused = F.concat(F.lit("sin acceso: "), F.col("__first.motive"))
    missing = F.when(F.col("unmatched") > 0, F.concat(F.col("unmatched").cast("string"), F.lit(" sin datos de Teams")))
    return agg.withColumn("note", F.concat_ws("; ", refused, missing)).drop("__first")
