"""Incremental mail run scenarios (cap, ties, second key, strikes,
exclusion, stop after five failures)."""
import datetime as dt

from pyspark.sql import functions as F

from comms_lake.operators import mail as M

T0 = dt.datetime(2024, 3, 1, 9, 0, 0)
MSG = "profile bigint, id string, internet_id string, received timestamp_ntz, folder_id string, subject string, pos int"
FOLDERS = [("root", "Raíz", "root"), ("inbox", "Entrada", "root"), ("deleteditems", "Eliminados", "root"),
           ("junkemail", "No deseado", "root"), ("child", "Hija", "deleteditems"), ("sub", "Sub", "inbox")]


def msgs(spark, rows):
    return spark.createDataFrame([(0, i, inet, ts, f, "asunto", 0) for i, inet, ts, f in rows], MSG)


def run_once(spark, rows, cap=10, mark=T0 - dt.timedelta(days=1), index=(), inet=(), skipped=(), fails=()):
    m = msgs(spark, rows)
    marks = spark.createDataFrame([(0, mark, "state")], "profile bigint, mark timestamp_ntz, source string")
    folders = spark.createDataFrame(FOLDERS, "folder_id string, display_name string, parent_id string")
    excl = M.excluded_folder_ids(folders, ["junkemail", "deleteditems", "drafts"])
    idx = spark.createDataFrame([(0, i) for i in index], "profile bigint, id string")
    inn = spark.createDataFrame([(0, i) for i in inet], "profile bigint, internet_id string")
    sk = spark.createDataFrame([(0, i) for i in skipped], "profile bigint, id string")
    fl = spark.createDataFrame([(0, i, n) for i, n in fails], "profile bigint, id string, prior_strikes bigint")
    flags = M.classify(m, marks, idx, inn, sk, excl, fl, 10)
    run = M.run_mail(flags, cap)
    summary = M.run_summary(run, marks).first()
    got = {r["id"]: r["outcome"] for r in run.filter("processed").select("id", "outcome").collect()}
    return got, summary


def flags_of(spark, rows, index=(), skipped=(), fails=(), remembered=None):
    marks = spark.createDataFrame([(0, T0 - dt.timedelta(days=1), "state")], "profile bigint, mark timestamp_ntz, source string")
    folders = spark.createDataFrame(FOLDERS, "folder_id string, display_name string, parent_id string")
    ids = lambda xs: spark.createDataFrame([(0, i) for i in xs], "profile bigint, id string")
    fl = spark.createDataFrame([(0, i, n) for i, n in fails], "profile bigint, id string, prior_strikes bigint")
    none = spark.createDataFrame([], "profile bigint, internet_id string")
    return M.classify(msgs(spark, rows), marks, ids(index), none, ids(skipped), M.excluded_folder_ids(folders, ["junkemail"]),
                      fl, 10, None if remembered is None else ids(remembered))


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_exclusion_includes_nested_folders(spark):
    rows = [("a", "", at(1), "inbox"), ("b", "", at(2), "junkemail"), ("c", "", at(3), "child"),
            ("d", "", at(4), "sub"), ("e", "", at(5), "unknown-folder")]
    got, _ = run_once(spark, rows)
    assert got == {"a": "written", "b": "excluded", "c": "excluded", "d": "written", "e": "written"}


def test_cap_two_two_one_over_runs(spark):
    rows = [(f"m{i}", f"<m{i}>", at(i * 30), "inbox") for i in range(5)]
    index, inet, mark, per_run = [], [], T0 - dt.timedelta(days=1), []
    for _ in range(3):
        got, s = run_once(spark, rows, cap=2, mark=mark, index=index, inet=inet)
        new = sorted(k for k, v in got.items() if v == "written")
        per_run.append(len(new))
        index += new
        inet += [f"<{i}>" for i in new]
        mark = dt.datetime.fromisoformat(s["new_mark"])
    assert per_run == [2, 2, 1]
    assert sorted(index) == [f"m{i}" for i in range(5)]


def test_ties_over_the_cap_all_arrive(spark):
    rows = [("a", "", at(0), "inbox"), ("b", "", at(0), "inbox"), ("c", "", at(0), "inbox"), ("d", "", at(5), "inbox")]
    got, s = run_once(spark, rows, cap=2)
    assert got == {"a": "written", "b": "written"} and s["stop"] == "tope"
    got2, _ = run_once(spark, rows, cap=2, mark=dt.datetime.fromisoformat(s["new_mark"]), index=["a", "b"])
    assert got2 == {"a": "known", "b": "known", "c": "written", "d": "written"}


def test_second_key_makes_a_copy_known(spark):
    rows = [("new-id", "<same@x>", at(1), "inbox"), ("other", "", at(2), "inbox")]
    got, _ = run_once(spark, rows, index=["old-id"], inet=["<same@x>"])
    assert got == {"new-id": "known", "other": "written"}


def test_three_strikes_then_skip_and_mark_advances(spark):
    rows = [("bad", "", at(1), "inbox"), ("ok", "", at(2), "inbox")]
    got1, s1 = run_once(spark, rows, fails=[("bad", 0)])
    assert got1 == {"bad": "failed", "ok": "written"} and s1["new_mark"] == s1["mark"]   # frozen
    got3, s3 = run_once(spark, rows, fails=[("bad", 2)], index=["ok"])
    assert got3 == {"bad": "skipped", "ok": "known"}
    assert s3["new_mark"].startswith("2024-03-01 09:02")                                   # advanced
    assert s1["status"] == "error: 1 correos sin escribir" and s3["status"] == "ok"


def test_five_consecutive_failures_stop_the_run(spark):
    rows = [(f"f{i}", "", at(i), "inbox") for i in range(7)] + [("g", "", at(20), "inbox")]
    got, s = run_once(spark, rows, fails=[(f"f{i}", 0) for i in range(7)])
    assert sorted(got) == [f"f{i}" for i in range(5)] and s["stop"] == "errores"


def test_known_rows_do_not_use_the_cap(spark):
    rows = [("k1", "", at(1), "inbox"), ("k2", "", at(2), "inbox"), ("n1", "", at(3), "inbox"), ("n2", "", at(4), "inbox")]
    got, _ = run_once(spark, rows, cap=1, index=["k1", "k2"])
    assert got == {"k1": "known", "k2": "known", "n1": "written"}


def test_plan_against_stored_files(spark):
    import hashlib
    m = msgs(spark, [("new", "", at(1), "inbox"), ("old", "", at(1), "inbox"), ("twin", "", at(1), "inbox")])
    stored = spark.createDataFrame([("old", "correo/acme/2024-03-01/0901-asunto.md")], "id string, path string")
    plan = {r["id"]: (r["path"], r["status"]) for r in
            M.plan_against_existing(m, stored, F.lit("acme")).collect()}
    assert plan["old"] == ("correo/acme/2024-03-01/0901-asunto.md", "already")     # written before the index
    h = lambda s: hashlib.sha1(s.encode()).hexdigest()[:6]
    assert plan["new"] == (f"correo/acme/2024-03-01/0901-asunto-{h('new')}.md", "planned")   # bare name is taken
    assert plan["twin"] == (f"correo/acme/2024-03-01/0901-asunto-{h('twin')}.md", "planned")


def test_second_key_inside_a_run(spark):
    """The first written row records the internet id; from the next row on it is known and free."""
    rows = [("j", "<x>", at(0), "junkemail"), ("f", "<x>", at(1), "inbox"), ("w", "<x>", at(2), "inbox"),
            ("c1", "<x>", at(3), "inbox"), ("c2", "<x>", at(4), "junkemail"), ("c3", "<x>", at(5), "inbox"),
            ("n", "<y>", at(6), "inbox"), ("s", "<x>", at(7), "inbox"), ("i", "<x>", at(8), "inbox")]
    flags = flags_of(spark, rows, index=["i"], skipped=["s"], fails=[("f", 0), ("c3", 0)])
    run = M.run_mail(flags, cap=2)
    got = {r["id"]: r["outcome"] for r in run.filter("processed").collect()}
    assert got == {"j": "excluded", "f": "failed", "w": "written", "c1": "known", "c2": "known", "c3": "known"}  # n: over the cap
    uncapped = M.run_mail(flags)
    got = {r["id"]: r["outcome"] for r in uncapped.filter("processed").collect()}
    assert got["n"] == "written" and got["s"] == "known" and got["i"] == "known"
    # aliases: recorded by this run's write, and not in the id index (the skip list is not the index)
    assert {r["id"] for r in M.alias_backfill(uncapped).collect()} == {"c1", "c2", "c3", "s"}


def test_remembered_rows_are_evaluated_again(spark):
    rows = [("w", "<x>", at(1), "inbox"), ("r", "<x>", at(2), "inbox"), ("still", "", at(3), "junkemail")]
    run = M.run_mail(flags_of(spark, rows, remembered=["r", "still"]), cap=1)
    assert {r["id"]: r["outcome"] for r in run.filter("processed").collect()} == {
        "w": "written", "r": "written", "still": "excluded"}


def test_rows_without_time_or_id(spark):
    rows = [("", "", at(1), "inbox"), (None, "", at(1), "inbox"), ("t", "", None, "inbox"), ("ok", "", at(2), "inbox")]
    got, s = run_once(spark, rows)
    assert got == {"t": "skipped", "ok": "written"} and s["new_mark"].startswith("2024-03-01 09:02")


def test_long_outage_stops_at_the_fifth_failure(spark):
    rows = [("a", "", at(0), "inbox")] + [(f"f{i:02d}", "", at(1 + i), "inbox") for i in range(30)]
    got, s = run_once(spark, rows, fails=[(f"f{i:02d}", 2 if i < 3 else 0) for i in range(30)])
    assert got["a"] == "written" and [k for k, v in sorted(got.items()) if v == "skipped"] == ["f00", "f01", "f02"]
    assert [k for k, v in sorted(got.items()) if v == "failed"] == ["f03", "f04"] and s["stop"] == "errores"


def test_gaps_in_stored_suffixes_are_filled(spark):
    import hashlib
    h = hashlib.sha1(b"new").hexdigest()[:6]
    m = msgs(spark, [("new", "", at(1), "inbox")])
    base = "correo/acme/2024-03-01/0901-asunto"
    stored = spark.createDataFrame([("o1", f"{base}.md"), ("o2", f"{base}-{h}.md"), ("o3", f"{base}-{h}-3.md")], "id string, path string")
    assert M.plan_against_existing(m, stored, F.lit("acme")).first()["path"] == f"{base}-{h}-2.md"


def test_closure_has_no_depth_limit_and_ends_on_cycles(spark):
    chain = [(f"c{i}", f"n{i}", f"c{i - 1}" if i else "c0") for i in range(25)] + [("x", "x", "y"), ("y", "y", "x"), ("z", "z", "gone")]
    folders = spark.createDataFrame(chain, "folder_id string, display_name string, parent_id string")
    got = {(r[0], r[1]): r[2] for r in M.folder_closure(folders).collect()}
    assert got["c24", "c0"] == 24 and got["x", "y"] == 1 and got["y", "y"] == 0 and got["z", "gone"] == 1
    assert len(got) == 25 * 26 // 2 + 4 + 2
    assert max(r[2] for r in M.folder_closure(folders, max_depth=10).collect()) == 9


def test_newest_and_phrase_search_with_since_and_sender(spark):
    m = msgs(spark, [("a", "", at(1), "inbox"), ("b", "", at(2), "inbox"), ("c", "", at(3), "sub")])
    assert {r["id"] for r in M.newest(m, ["profile", "folder_id"], 1).collect()} == {"b", "c"}
    assert M.newest(m, ["profile", "folder_id"]).count() == 3
    docs = spark.createDataFrame([("a", "Plan", "x", "Ana <ana@x>", at(1)), ("b", "x", "the PLAN", "", at(5)),
                                  ("c", "x", None, "plan@x", at(9)), ("d", "x", "y", "z", at(9))],
                                 "id string, subject string, body string, sender string, received timestamp_ntz")
    assert {r["id"] for r in M.phrase_search(docs, "Plan").collect()} == {"a", "b", "c"}
    since = F.col("received") >= F.lit(at(5))
    assert {r["id"] for r in M.phrase_search(docs, "plan", since).collect()} == {"b", "c"}


def test_excluded_messages_are_checked_again(spark):
    """Gone, still excluded, moved to a normal folder; least recently checked first; age and size."""
    days = lambda n: T0 - dt.timedelta(days=n)
    mem = spark.createDataFrame([(0, "gone", days(1), days(1), False), (0, "junk", days(2), days(2), False),
                                 (0, "back", days(3), days(3), False), (0, "fresh", days(0), days(0), True),
                                 (0, "old", days(9), days(0), False)],
                                "profile bigint, id string, desde timestamp_ntz, revisado timestamp_ntz, new boolean")
    now = spark.createDataFrame([(0, "junk", "child"), (0, "back", "inbox"), (0, "old", "junkemail"), (0, "fresh", "inbox")],
                                "profile bigint, id string, folder_id string")
    folders = spark.createDataFrame(FOLDERS, "folder_id string, display_name string, parent_id string")
    bad = M.excluded_folder_ids(folders, ["junkemail", "deleteditems"])
    at_run = spark.createDataFrame([(T0,)], "run_at timestamp_ntz")
    got = lambda **k: {r["id"]: r["action"] for r in M.recheck_excluded(mem, now, bad, at_run, **k).collect()}
    assert got() == {"gone": "forgotten", "junk": "rechecked", "back": "rescued", "fresh": "kept", "old": "rechecked"}
    assert got(per_run=2) == {"back": "rescued", "junk": "rechecked", "gone": "kept", "old": "kept", "fresh": "kept"}
    assert got(keep_days=7)["old"] == "pruned" and got(keep_days=7)["junk"] == "rechecked"
    assert {k for k, v in got(keep_max=1).items() if v == "pruned"} == {"junk", "old"}
