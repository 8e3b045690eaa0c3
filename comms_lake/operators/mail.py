"""Incremental mail selection.

One lazy plan per run: cursor filter, first occurrence per id, known test
(id index, skip list, internet-id index), folder-tree exclusion, the
per-run cap, the five-failures stop, outcomes and the new high-water mark.

The sequential rules of the reference (cap, stop after five consecutive
failures, mark frozen at the first failure) are rewritten as prefix sums
and per-profile minima (see ``ordered.prefix_sums``), never as a window
over a whole mailbox.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import times as TM
from ..session import bounded, literal_table, materialize, with_params
from .ordered import prefix_sums

# --- fixed values (reference constants) -----------------------------------
MAX_CONSECUTIVE_WRITE_ERRORS = 5
WRITE_FAILURES_BEFORE_SKIP = 3
PAGE_SIZE = 50
MAX_PAGE_TOP = 1000


# -- folders ------------------------------------------------------------------

def folder_closure(folders: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(folder_id, ancestor_id, depth) for every folder and its ancestors,
    stopping at a missing or self parent (J2); ``max_depth`` limits the
    folders of a chain (None: no limit).

    Each round joins the pairs found so far with themselves, which doubles
    the length of the chains covered, and is a written table; it ends when no
    pair is new, so rounds grow with the logarithm of the depth and a cycle of
    parents ends as well. Messages are never recursed over.
    """
    own = folders.select("folder_id", F.col("folder_id").alias("ancestor_id"), F.lit(0).alias("depth"))
    parent = folders.filter(F.col("parent_id").isNotNull() & (F.col("parent_id") != "") & (F.col("parent_id") != F.col("folder_id")))
    pairs = materialize(own.unionByName(parent.select("folder_id", F.col("parent_id").alias("ancestor_id"),
                                                      F.lit(1).alias("depth"))), "closure")
    count = pairs.count()
    while True:
        above = pairs.select(F.col("folder_id").alias("ancestor_id"), F.col("ancestor_id").alias("__top"),
                             F.col("depth").alias("__more"))
        longer = pairs.join(above, "ancestor_id").select("folder_id", F.col("__top").alias("ancestor_id"),
                                                         (F.col("depth") + F.col("__more")).alias("depth"))
        pairs = materialize(pairs.unionByName(longer).groupBy("folder_id", "ancestor_id").agg(F.min("depth").alias("depth")), "closure")
        before, count = count, pairs.count()
        if count == before:
            return pairs if max_depth is None else pairs.filter(F.col("depth") < max_depth)


def excluded_folder_ids(folders: DataFrame, exclude_names: list[str]) -> DataFrame:
    """Folders that are, or descend from, an excluded folder.

    Names resolve to ids by exact match on the well-known id; unknown names
    are ignored, like the reference's 404 branch.
    """
    spark = folders.sparkSession
    names = literal_table(spark, [(n.strip(),) for n in exclude_names if n.strip()], "ancestor_id string")
    roots = names.join(folders.select(F.col("folder_id").alias("ancestor_id")), "ancestor_id", "left_semi")
    return (folder_closure(folders).join(roots, "ancestor_id", "left_semi")
            .select("folder_id").distinct())


# -- marks --------------------------------------------------------------------

def effective_marks(messages: DataFrame, state: DataFrame, run_at: DataFrame,
                    backfill_days: int) -> DataFrame:
    """Per profile: saved mark, or ``run_at - backfill_days`` on a first
    run (F2); ``source`` says which."""
    profiles = messages.select("profile").distinct()
    return (with_params(profiles.join(state, "profile", "left"), run_at)
            .select("profile",
                    F.coalesce("marca", F.col("run_at") - F.make_dt_interval(days=F.lit(backfill_days)))
                    .alias("mark"),
                    F.when(F.col("marca").isNull(), F.lit("backfill")).otherwise(F.lit("state")).alias("source")))


# -- the run ------------------------------------------------------------------

def first_occurrence(df: DataFrame) -> DataFrame:
    """The first listing of each (profile, id) by (received, pos).

    A grouped ``min`` of a struct: map-side partial aggregation, groups are
    one id each, so no hot key.
    """
    cols = [c for c in df.columns if c not in ("profile", "id")]
    packed = F.struct(F.col("received"), F.col("pos"), *[F.col(c).alias(f"c_{c}") for c in cols])
    return (df.groupBy("profile", "id").agg(F.min(packed).alias("__m"))
            .select("profile", "id", *[F.col(f"__m.c_{c}").alias(c) for c in cols]))


def candidates(messages: DataFrame, marks: DataFrame, overlap_minutes: int) -> DataFrame:
    """rows from each profile's mark minus the overlap on. The least mark
    of all profiles, a scalar subquery, prunes the scan; the per-profile mark
    arrives by a join whose side is one row a profile. Rows without a time
    stay (they become ``skipped``, F9)."""
    back = F.make_dt_interval(mins=F.lit(overlap_minutes))
    least = marks.agg(F.min("mark").alias("least"))
    rows = messages.filter(F.col("received").isNull() | (F.col("received") >= least.scalar() - back))
    return (rows.join(bounded(marks.select("profile", "mark")), "profile")
            .filter(F.col("received").isNull() | (F.col("received") >= F.col("mark") - back)))


def classify(messages: DataFrame, marks: DataFrame, index_ids: DataFrame, internet_index: DataFrame,
             skipped: DataFrame, excluded_folders: DataFrame, failures: DataFrame,
             overlap_minutes: int, remembered: DataFrame | None = None) -> DataFrame:
    """Cursor filter (F1), first occurrence (W1) and per-row flags.

    known: id written or skipped before, or non-empty internet id recorded by
    an earlier run (J4, J5) or by a row of this run that comes first in
    (received, id) order and is written; excluded: folder in an excluded
    subtree (J3); failing and strike3 from this run's write outcome (W5);
    free: known, or an id the exclusion memory holds, which is re-evaluated
    without using the cap. alias_only (J6): known by the internet id alone
    and not in the id index (an id in the skip list is not in the index).
    """
    firsts = first_occurrence(candidates(messages, marks, overlap_minutes)
                              .filter(F.col("id").isNotNull() & (F.col("id") != "")))
    flag = lambda df, name: df.distinct().withColumn(name, F.lit(True))
    joined = (firsts.join(flag(index_ids.select("profile", "id"), "__index"), ["profile", "id"], "left")
              .join(flag(skipped.select("profile", "id"), "__skip"), ["profile", "id"], "left")
              .join(flag(internet_index.select("profile", "internet_id"), "__inet"), ["profile", "internet_id"], "left")
              .join(flag(excluded_folders, "__excluded"), "folder_id", "left")
              .join(flag(failures.select("profile", "id", "prior_strikes"), "__fails"), ["profile", "id"], "left"))
    if remembered is not None:
        joined = joined.join(flag(remembered.select("profile", "id"), "__mem"), ["profile", "id"], "left")
    else:
        joined = joined.withColumn("__mem", F.lit(False))
    yes = lambda c: F.coalesce(c, F.lit(False))
    named = X.s("internet_id") != ""
    mem, indexed = yes("__mem"), yes("__index")
    inet = named & yes("__inet")
    known = ~mem & (indexed | yes("__skip") | inet)
    excluded = ~known & yes("__excluded")
    valid = F.col("received").isNotNull()
    failing = ~known & ~excluded & valid & yes("__fails")
    rows = joined.withColumns({"__mem": mem, "__index": indexed, "__inet": inet, "known": known,
                               "excluded": excluded, "failing": failing, "__key": F.struct("received", "id")})
    rows = materialize(rows.drop("__skip", "__excluded", "__fails"), "mail-rows")  # read twice below: one scan and one set of joins
    # the second key inside the run: who writes an internet id first; later rows find it recorded
    writes = named & ~F.col("known") & ~F.col("excluded") & valid & ~F.col("failing")
    writers = rows.filter(writes).groupBy("profile", "internet_id").agg(F.min("__key").alias("__writer"))
    rows = rows.join(writers, ["profile", "internet_id"], "left")
    recorded = F.col("__inet") | yes(F.col("__key") > F.col("__writer"))
    repeat = ~F.col("__mem") & yes(F.col("__key") > F.col("__writer"))
    known = F.col("known") | repeat
    excluded, failing = F.col("excluded") & ~repeat, F.col("failing") & ~repeat
    strike3 = failing & (F.coalesce("prior_strikes", F.lit(0)) + 1 >= WRITE_FAILURES_BEFORE_SKIP)
    return (rows.withColumns({"known": known, "free": known | F.col("__mem"), "excluded": excluded, "failing": failing,
                              "strike3": strike3, "alias_only": ~F.col("__mem") & ~F.col("__index") & recorded})
            .drop("__index", "__inet", "__mem", "__key", "__writer"))


def run_mail(flags: DataFrame, cap: int | None = None) -> DataFrame:
    """Apply the cap (W2; None: no cap) and the five-failures stop (W4); add
    ``processed``, ``outcome`` and the ordering key.

    counted rows use the cap: unknown rows that do not fail, plus strike-3
    rows. The run stops before the first unknown row met after ``cap``
    counted rows, and after the fifth consecutive failure (a strike-3 row
    extends a failure run but never triggers the stop itself).
    """
    counted = ~F.col("free") & ~(F.col("failing") & ~F.col("strike3"))
    flags = flags.withColumn("key", F.struct("received", "id"))
    first_day = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")  # rows without a time come first
    seq = prefix_sums(flags, ["profile"], ["received", "id"],
                      F.coalesce(F.date_trunc("day", F.col("received")).cast("timestamp_ntz"), first_day),
                      {"counted_cum": counted, "resets_cum": ~F.col("failing"), "fails_cum": F.col("failing")})
    # three branches read the sequence (cap stop, error stop, rows): one written table
    seq = materialize(seq.withColumn("counted_before", F.col("counted_cum") - counted.cast("bigint")), "mail-run")

    cap_rows = seq.filter(~F.col("free") & (F.col("counted_before") >= cap)) if cap is not None else seq.limit(0)
    cap_stop = cap_rows.groupBy("profile").agg(F.min("key").alias("cap_stop_key"))
    # the resets counted so far name the run a failure belongs to; its length so far is the failures
    # counted since the run's first, so a long outage needs no window over its rows
    fails = seq.filter(F.col("failing"))
    runs = (fails.groupBy("profile", "resets_cum").agg(F.min("fails_cum").alias("start"), F.count("*").alias("n"))
            .filter(F.col("n") >= MAX_CONSECUTIVE_WRITE_ERRORS).drop("n"))
    err_stop = (fails.join(bounded(runs), ["profile", "resets_cum"])
                .filter(~F.col("strike3") & (F.col("fails_cum") - F.col("start") + 1 >= MAX_CONSECUTIVE_WRITE_ERRORS))
                .groupBy("profile").agg(F.min("key").alias("err_stop_key")))
    stops = materialize(cap_stop.join(err_stop, "profile", "full"), "mail-stops")
    out = seq.join(bounded(stops), "profile", "left")
    processed = ((F.col("cap_stop_key").isNull() | (F.col("key") < F.col("cap_stop_key")))
                 & (F.col("err_stop_key").isNull() | (F.col("key") <= F.col("err_stop_key"))))
    outcome = (F.when(F.col("known"), F.lit("known"))
               .when(F.col("excluded"), F.lit("excluded"))
               .when(F.col("received").isNull(), F.lit("skipped"))
               .when(F.col("strike3"), F.lit("skipped"))
               .when(F.col("failing"), F.lit("failed"))
               .otherwise(F.lit("written")))
    return out.withColumns({"processed": processed, "outcome": outcome}).drop("fails_cum")


def run_summary(run: DataFrame, marks: DataFrame) -> DataFrame:
    """Per profile: old and new mark (W3), counts, stop reason, status."""
    p = run.filter("processed")
    first_fail = (p.filter(F.col("failing") & ~F.col("strike3"))
                  .groupBy("profile").agg(F.min("key").alias("first_fail_key")))
    stops = run.select("profile", "cap_stop_key", "err_stop_key").distinct()
    agg = (p.join(bounded(first_fail), "profile", "left")
           .groupBy("profile").agg(
               F.max(F.when(F.col("first_fail_key").isNull() | (F.col("key") < F.col("first_fail_key")),
                            F.col("received"))).alias("advanced_to"),
               F.count("*").alias("processed"),
               F.count_if(F.col("outcome") == "written").alias("written"),
               F.count_if(F.col("outcome") == "known").alias("known"),
               F.count_if(F.col("outcome") == "excluded").alias("excluded"),
               F.count_if(F.col("failing")).alias("errors"),
               F.count_if(F.col("strike3")).alias("skipped_now")))
    out = marks.join(agg, "profile", "left").join(stops, "profile", "left")
    new_mark = F.when(F.col("advanced_to") > F.col("mark"), F.col("advanced_to")).otherwise(F.col("mark"))
    stop = (F.when(F.col("err_stop_key").isNotNull() &
                   (F.col("cap_stop_key").isNull() | (F.col("err_stop_key") < F.col("cap_stop_key"))),
                   F.lit("errores"))
            .when(F.col("cap_stop_key").isNotNull(), F.lit("tope")).otherwise(F.lit("")))
    unwritten = F.coalesce(F.col("errors"), F.lit(0)) - F.coalesce(F.col("skipped_now"), F.lit(0))
    status = F.when(unwritten > 0, F.concat(F.lit("error: "), unwritten.cast("string"),
                                            F.lit(" correos sin escribir"))).otherwise(F.lit("ok"))
    return out.select(
        "profile",
        F.date_format("mark", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("mark"),
        F.date_format(new_mark, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("new_mark"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
          for c in ("processed", "written", "known", "excluded", "errors", "skipped_now")],
        stop.alias("stop"), status.alias("status"))


def failure_runs(run: DataFrame) -> DataFrame:
    """Failure islands among processed rows (W4): start id, length, whether
    the island stopped the run."""
    p = run.filter(F.col("processed") & F.col("failing"))
    return (p.groupBy("profile", "resets_cum").agg(
        F.min("key").alias("first"), F.count("*").alias("n_failures"),
        F.count_if(F.col("strike3")).alias("n_strike3"),
        F.max(F.col("key") == F.col("err_stop_key")).alias("stopped_run"))
        .select("profile", F.col("first.id").alias("first_id"), "n_failures", "n_strike3",
                F.coalesce("stopped_run", F.lit(False)).alias("stopped_run")))


def strikes(run: DataFrame) -> DataFrame:
    """Strike counter per failing id (W5): strikes after this run and
    whether the id moves to the skip list (K7)."""
    p = run.filter(F.col("processed") & F.col("failing"))
    return p.select("profile", "id",
                    (F.col("prior_strikes") + 1).cast("bigint").alias("strikes"),
                    F.col("strike3").alias("to_skip_list"))


def collision_names(d: DataFrame, order: list[str], id_col: str) -> DataFrame:
    """File ``name`` per row of (dir, stem). The first arrival in
    ``order`` keeps the stem; later ones take ``-sha6(id)``; an equal sha6
    under the same stem adds ``-2``, ``-3``... Windows are partitioned by
    (directory, stem): one minute, or day, of one subject."""
    w = Window.partitionBy("dir", F.lower("stem")).orderBy(*order)
    d = d.withColumn("arrival", F.row_number().over(w)).withColumn("h6", X.sha_hex(id_col, 6))
    later = Window.partitionBy("dir", F.lower("stem"), "h6", F.col("arrival") > 1).orderBy(*order)
    d = d.withColumn("h_rank", F.when(F.col("arrival") > 1, F.row_number().over(later)))
    return d.withColumn("name", F.when(F.col("arrival") == 1, F.col("stem"))
                        .when(F.col("h_rank") == 1, F.concat_ws("-", "stem", "h6"))
                        .otherwise(F.concat_ws("-", F.col("stem"), F.col("h6"), F.col("h_rank").cast("string"))))


def collision_paths(rows: DataFrame, empresa: Column, zone: str = TM.UTC) -> DataFrame:
    """Immutable document path ``correo/<empresa>/<day>/HHmm-slug.md``, fitted
    to the path limit (X18), with the collision suffixes of W6."""
    d = rows.withColumn("dir", F.concat(F.lit("correo/"), empresa, F.lit("/"),
                                        F.date_format(TM.to_local("received", zone), "yyyy-MM-dd")))
    d = d.withColumn("stem0", F.concat(TM.hhmm("received", zone), F.lit("-"), X.slug_ascii("subject")))
    d = d.withColumn("stem", X.fit_path_stem(F.col("dir"), F.col("stem0"), ".md"))
    d = collision_names(d, ["received", "id"], "id")
    return d.withColumn("path", F.concat(F.col("dir"), F.lit("/"), F.col("name"), F.lit(".md")))


def plan_against_existing(rows: DataFrame, existing: DataFrame, empresa: Column, zone: str = TM.UTC) -> DataFrame:
    """J15 + W6: plan document paths for a new run next to files written by
    earlier runs (``existing``: id, path).

    An id already stored under one of its own candidate names is
    ``already`` (an earlier run wrote it but may have stopped before the
    index). Otherwise the bare name goes to the first new arrival unless a
    stored file holds it, and a hashed name skips the numbers that stored
    files hold, filling gaps. All joins are on (directory, stem) keys.
    """
    d = rows.withColumn("dir", F.concat(F.lit("correo/"), empresa, F.lit("/"),
                                        F.date_format(TM.to_local("received", zone), "yyyy-MM-dd")))
    d = d.withColumn("stem", X.fit_path_stem(F.col("dir"), F.concat(TM.hhmm("received", zone), F.lit("-"),
                                                                    X.slug_ascii("subject")), ".md"))
    d = d.withColumn("h6", X.sha_hex("id", 6))
    ex = existing.select(F.col("id").alias("ex_id"), F.lower("path").alias("ex_path"))
    # stored names parsed back into (dir, stem, suffix)
    parts = ex.select("ex_id", "ex_path",
                      F.regexp_extract("ex_path", "^(.*)/[^/]*$", 1).alias("dir_l"),
                      F.regexp_extract("ex_path", "/([^/]*)\\.md$", 1).alias("name"))
    bare = parts.select("dir_l", F.col("name").alias("stem_l"), F.lit(True).alias("bare_taken")).distinct()
    # suffix numbers that stored files hold: none is 1, then -2, -3, ... (one stem and hash: a few)
    hashed = (parts.filter(F.col("name").rlike("-[0-9a-f]{6}(-\\d+)?$"))
              .select("dir_l", F.regexp_extract("name", "^(.*-[0-9a-f]{6})(-\\d+)?$", 1).alias("h_l"),
                      F.coalesce(F.expr("try_cast(regexp_extract(name, '-[0-9a-f]{6}-([0-9]+)$', 1) AS bigint)"), F.lit(1))
                      .alias("number"))
              .groupBy("dir_l", "h_l").agg(F.collect_set("number").alias("h_taken")))
    mine = d.join(ex, F.col("ex_id") == F.col("id"), "left_semi")
    fresh = d.join(ex, F.col("ex_id") == F.col("id"), "left_anti")
    fresh = (fresh.join(bare, (F.lower("dir") == F.col("dir_l")) & (F.lower("stem") == F.col("stem_l")), "left")
             .drop("dir_l", "stem_l"))
    w = Window.partitionBy("dir", F.lower("stem")).orderBy("received", "id")
    fresh = fresh.withColumn("arrival", F.row_number().over(w)
                             + F.when(F.coalesce("bare_taken", F.lit(False)), 1).otherwise(0))
    fresh = (fresh.join(hashed, (F.lower("dir") == F.col("dir_l"))
                        & (F.lower(F.concat_ws("-", "stem", "h6")) == F.col("h_l")), "left").drop("dir_l", "h_l"))
    later = Window.partitionBy("dir", F.lower("stem"), "h6", F.col("arrival") > 1).orderBy("received", "id")
    # the n-th later arrival takes the n-th number that no stored file holds
    taken = F.coalesce("h_taken", F.array().cast("array<bigint>"))
    fresh = fresh.withColumn("__n", F.row_number().over(later).cast("bigint"))
    free = F.array_except(F.sequence(F.lit(1).cast("bigint"), F.col("__n") + F.size(taken)), taken)
    fresh = fresh.withColumn("h_rank", F.when(F.col("arrival") > 1, F.element_at(free, F.col("__n").cast("int")))).drop("__n")
    name = (F.when(F.col("arrival") == 1, F.col("stem"))
            .when(F.col("h_rank") == 1, F.concat_ws("-", "stem", "h6"))
            .otherwise(F.concat_ws("-", F.col("stem"), F.col("h6"), F.col("h_rank").cast("string"))))
    planned = fresh.select("profile", "id", F.concat(F.col("dir"), F.lit("/"), name, F.lit(".md")).alias("path"),
                           F.lit("planned").alias("status"))
    known = (mine.join(existing.select("id", "path"), "id")
             .select("profile", "id", "path", F.lit("already").alias("status")))
    return planned.unionByName(known)


def tie_groups(messages: DataFrame, bucket: Column) -> DataFrame:
    """Listing tie groups per (profile, bucket) with the page rules:
    more than a page needs a bigger page, more than 1000 forces a skip."""
    return (messages.groupBy("profile", bucket.alias("bucket")).agg(F.count("*").alias("n"))
            .filter(F.col("n") > 1)
            .select("profile", F.date_format("bucket", "yyyy-MM-dd HH:mm:ss").alias("bucket"), "n",
                    (F.col("n") > PAGE_SIZE).alias("grows_page"),
                    (F.col("n") > MAX_PAGE_TOP).alias("skips_second")))


def alias_backfill(run: DataFrame) -> DataFrame:
    """Handled ids not in the id index whose internet id is recorded, by
    earlier runs or in this one; they join the index and produce no document."""
    return run.filter("processed AND alias_only").select("profile", "id", "internet_id")


def phrase_search(docs: DataFrame, phrase: str, since: Column | None = None) -> DataFrame:
    """F5 + F3: phrase match (case-insensitive) over subject, body and, where
    there is one, sender, then the since filter."""
    p = phrase.lower()
    hit = F.lit(False)
    for c in ("subject", "body", "sender"):
        if c in docs.columns:
            hit = hit | F.contains(F.lower(X.s(c)), F.lit(p))
    out = docs.filter(hit)
    if since is not None:
        out = out.filter(since)
    return out


def newest(messages: DataFrame, keys: list[str], n: int | None = None) -> DataFrame:
    """L2: rows ranked from the newest per key; with ``n``, the newest ``n``
    (``rank <= n`` lets Spark insert a partial per-partition group limit
    before the shuffle)."""
    w = Window.partitionBy(*keys).orderBy(F.col("received").desc(), F.col("id").desc())
    ranked = messages.withColumn("rank", F.row_number().over(w))
    return ranked if n is None else ranked.filter(F.col("rank") <= n)


def recheck_excluded(memory: DataFrame, snapshot: DataFrame, excluded_folders: DataFrame, run_at: DataFrame,
                     per_run: int | None = None, keep_days: int | None = None, keep_max: int | None = None) -> DataFrame:
    """J14 + W8 + W7: remembered excluded messages against the mailbox as it
    is now.

    ``memory``: profile, id, desde, revisado, new (first seen excluded this
    run: not re-checked); ``snapshot``: profile, id, folder_id. The ``per_run``
    least recently checked (all by default) are looked up: one that is gone
    is ``forgotten``, one still in an excluded folder is ``rechecked``, any
    other is ``rescued``. Then what stays is pruned: ``pruned`` are entries
    older than ``keep_days`` and those beyond the ``keep_max`` newest of a
    profile; the rest is ``kept``.
    """
    old = ~F.coalesce("new", F.lit(False))
    m = memory.withColumn("__check", old)
    if per_run is not None:
        least = Window.partitionBy("profile", "__check").orderBy("revisado", "id")
        m = m.withColumn("__check", old & (F.row_number().over(least) <= per_run))
    now = snapshot.select("profile", "id", F.col("folder_id").alias("__folder"), F.lit(True).alias("__there"))
    bad = excluded_folders.select(F.col("folder_id").alias("__folder"), F.lit(True).alias("__bad"))
    m = m.join(now, ["profile", "id"], "left").join(bounded(bad), "__folder", "left")
    action = (F.when(~F.col("__check"), F.lit("kept")).when(F.col("__there").isNull(), F.lit("forgotten"))
              .when(F.col("__bad"), F.lit("rechecked")).otherwise(F.lit("rescued")))
    m = with_params(m.withColumn("action", action), run_at)
    stays = F.col("action").isin("kept", "rechecked")
    if keep_days is not None:
        aged = F.col("desde") < F.col("run_at") - F.make_dt_interval(days=F.lit(keep_days))
        m = m.withColumn("action", F.when(stays & aged, F.lit("pruned")).otherwise(F.col("action")))
    if keep_max is not None:
        newest = Window.partitionBy("profile", stays).orderBy(F.col("desde").desc(), F.col("id").desc())
        over = F.row_number().over(newest) > keep_max
        m = m.withColumn("__over", over).withColumn("action", F.when(stays & F.col("__over"), F.lit("pruned")).otherwise(F.col("action")))
    return m.select("profile", "id", "action")
