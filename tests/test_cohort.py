import datetime as dt

from pyspark.sql import functions as F

from vigilo.functions import fixed
from vigilo.operators import cleaning, cohort, peers

C = F.col


def day(n):
    return dt.date(2010, 1, n) if n else None


def label(spark, enrolments, diplomas=(), horizon=2010, **options):
    members = spark.createDataFrame([(1, horizon), (2, horizon)], "k int, h int")
    e = spark.createDataFrame(
        [(k, day(end), y, c) for k, end, y, c in enrolments], "k int, ended date, wy int, code string"
    )
    d = spark.createDataFrame(list(diplomas), "k int, dy int")
    out = cohort.outcome_label(
        members, d, e, key="k", horizon="h", diploma_year="dy", end_date="ended", withdraw_year="wy", code="code", **options
    )
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_outcome_graduates_and_duplicates(spark):
    rows = label(spark, [(1, 5, 2010, "X"), (2, 5, 2010, "X"), (9, 5, 2010, "X")], [(1, 2011), (1, 2009), (2, 2012)])
    assert rows == [(1, "on-time", "Yes"), (2, "Late", "No")]


def test_outcome_ties_give_one_row_each(spark):
    rows = label(spark, [(1, 5, 2010, "DE"), (1, 5, 2010, "HSC"), (1, 3, 2010, "TNC"), (2, 5, 2010, None)])
    assert rows == [(1, "Late", None), (1, fixed.UNKNOWN_EXIT, None), (2, "Non-grad", None)]
    assert label(spark, [(1, 5, 2010, "DE"), (1, 5, 2010, "HSC")], one_row_per_key=True) == [(1, fixed.UNKNOWN_EXIT, None)]


def test_outcome_after_horizon_drops_other_latest_rows(spark):
    assert label(spark, [(1, 5, 2011, "DE"), (1, 5, 2010, "HSC")]) == [(1, "Non-grad", None)]


def test_outcome_missing_end_date_is_latest(spark):
    assert label(spark, [(1, None, 2010, "HSC"), (1, 9, 2010, "DE")]) == [(1, "Late", None)]


def test_outcome_is_judged_per_cohort(spark):
    members = spark.createDataFrame([("a", 1, 2010), ("b", 1, 2012)], "c string, k int, h int")
    e = spark.createDataFrame([(1, day(5), 2010, "X")], "k int, ended date, wy int, code string")
    d = spark.createDataFrame([(1, 2011)], "k int, dy int")
    out = cohort.outcome_label(
        members, d, e, key="k", horizon="h", diploma_year="dy", end_date="ended", withdraw_year="wy", code="code", by=["c"]
    )
    assert {(r["c"], r["grad_ind"]) for r in out.collect()} == {("a", "Late"), ("b", "on-time")}


def test_latest_rows_with_missing_dates(spark):
    df = spark.createDataFrame([(1, day(1)), (1, day(2)), (1, day(2)), (2, None), (2, day(3))], "k int, d date")
    got = sorted((r["k"], str(r["d"]), r["maxObsFlag"]) for r in cohort.latest_rows(df, ["k"], "d").collect())
    assert got == [
        (1, "2010-01-01", "No"), (1, "2010-01-02", "Yes"), (1, "2010-01-02", "Yes"), (2, "2010-01-03", "No"), (2, "None", "Yes"),
    ]


def test_dedupe_mode_tie_takes_smallest_year(spark):
    df = spark.createDataFrame([(1, 2003), (1, 2001), (2, 2004)], "k int, y int")
    got = {tuple(r) for r in cohort.dedupe_outcome(df, ["k"], year="y", on_time=C("y") <= 2002).collect()}
    assert got == {(1, 2001, 2003, "on-time", "Yes"), (2, 2004, 2004, "Late", "No")}


def test_subject_wide_forms(spark):
    df = spark.createDataFrame(
        [(1, "R", 10.0), (1, "R", 20.0), (1, "M", 1.0), (2, "R", 5.0)], "k int, s string, v double"
    )
    names = {"R": "READ", "M": "MATH"}
    pairs = cohort.subject_wide(df, ["k"], subject="s", subjects=names, measures=["v"])
    assert sorted(tuple(r) for r in pairs.collect()) == [(1, 10.0, 1.0), (1, 20.0, 1.0)]
    single = cohort.subject_wide(df, ["k"], subject="s", subjects=names, measures=["v"], combine="avg")
    assert [tuple(r) for r in single.collect()] == [(1, 15.0, 1.0)]


def test_incident_summary_rules(spark):
    df = spark.createDataFrame(
        [(1, "HG", 2.0, "EX"), (1, "SR", None, "OS"), (1, "SG", 1.0, "OS"), (1, "AS", 9.0, "IS"), (1, "AS", 9.0, None), (2, "ZZ", 3.0, "OS")],
        "k int, t string, d double, r string",
    )
    got = {tuple(r) for r in cohort.incident_summary(df, ["k"], type_col="t", days="d", removal="r").collect()}
    assert got == {(1, 3, "SchoolRule-Weapon", 3.0, "EX"), (2, 1, "ZZ", 3.0, "OS")}
    strict = cohort.incident_summary(df, ["k"], type_col="t", days="d", removal="r", missing_days_poison=True)
    assert {r["k"]: r["daysRemoved"] for r in strict.collect()} == {1: None, 2: 3.0}


def test_assemble_fills_or_leaves_discipline(spark):
    people = spark.createDataFrame([(1,), (2,)], "k int")
    tests = spark.createDataFrame([(1, 5.0)], "k int, READ_SS double")
    mobility = spark.createDataFrame([(2, 3)], "k int, SCHOOL_COUNT int")
    disc = spark.createDataFrame([(1, 2, "Drug", 1.5, "OS")], "k int, incCount long, incType string, daysRemoved double, removalType string")
    full = {r["k"]: r for r in cohort.assemble(people, ["k"], tests=tests, mobility=mobility, discipline=disc).collect()}
    assert (full[2]["incCount"], full[2]["incType"], full[2]["daysRemoved"], full[2]["removalType"]) == (0, "None", 0.0, "None")
    assert full[2]["READ_SS"] is None and full[1]["SCHOOL_COUNT"] is None
    none = cohort.assemble(people, ["k"], tests=tests, mobility=mobility, discipline=None)
    assert none.where("incCount IS NULL AND incType IS NULL AND daysRemoved IS NULL").count() == 2


def test_crosswalk_masks_and_keeps_current(spark):
    keymap = spark.createDataFrame([(1, "w1"), (2, "w2")], "k int, wsn string")
    xref = spark.createDataFrame([("a", "w1", "Y"), ("b", "w1", "N"), ("c", "w2", "Y")], "l string, wsn string, cur string")
    persons = spark.createDataFrame([(1, "Active"), (2, "Deleted")], "k int, st string")
    names = dict(shared_id="wsn", key="k", local_id="l", status="st")
    got = cohort.crosswalk(keymap, xref, persons, current=C("cur") == "Y", **names)
    assert {tuple(r) for r in got.collect()} == {("a", 1, "w1"), ("c", -2, "w2")}
    seen = spark.createDataFrame([("a",), ("a",), ("b",)], "l string")
    assert cohort.crosswalk(keymap, xref, persons, seen=seen, **names).count() == 2
    assert cohort.crosswalk(keymap, xref, persons, distinct=False, **names).count() == 3


def test_peer_stats_count_missing_as_match(spark):
    df = spark.createDataFrame(
        [
            ("s", 10.0, 1.0, 2, 10, 100, "White", "Yes", "N"),
            ("s", 20.0, None, None, 30, 100, None, None, None),
            ("s", None, 3.0, 0, None, None, "Black", "No", "F"),
            ("z", None, None, 0, 0, 0, "White", "No", "N"),
            (None, 1.0, 1.0, 0, 1, 2, "White", "No", "N"),
        ],
        "SCHOOL_KEY string, READ_SS double, MATH_SS double, incCount int, STUDENT_ANNUAL_ABSENCES int, "
        "STUDENT_ANNUAL_ENROLLMENT_DAYS int, STUDENT_RACE string, STUDENT_SPECIAL_ED_INDICATOR string, "
        "STUDENT_FOODSERVICE_ELIG_CODE string",
    )
    rows = {r["cohort_SCHOOL_KEY"]: r for r in peers.peer_stats(df, ["SCHOOL_KEY"]).collect()}
    s = rows["s"]
    assert s["cohort_size"] == 3 and s["cohort_mean_read"] == 15.0 and s["cohort_suspPeers"] == 1
    assert abs(s["cohort_mean_attend"] - 0.8) < 1e-12
    assert abs(s["cohort_SwDper"] - 2 / 3) < 1e-12 and abs(s["cohort_FRLper"] - 2 / 3) < 1e-12
    assert abs(s["cohort_nonWhitePer"] - 2 / 3) < 1e-12
    assert rows["z"]["cohort_mean_attend"] is None and rows["z"]["cohort_mean_read"] is None
    plain = {r["cohort_SCHOOL_KEY"]: r for r in peers.peer_stats(df, ["SCHOOL_KEY"], null_counts_as_match=False).collect()}
    assert abs(plain["s"]["cohort_SwDper"] - 1 / 3) < 1e-12
    back = peers.peer_enriched(df, ["SCHOOL_KEY"])
    assert back.count() == 5
    assert back.where("SCHOOL_KEY IS NULL").first()["cohort_size"] == 1


def test_complete_cases_and_outcome(spark):
    df = spark.createDataFrame([(1, "on-time"), (None, "Late"), (3, fixed.UNKNOWN_EXIT), (4, "Non-grad")], "a int, grad_ind string")
    row = cleaning.complete_case_counts(df).first()
    assert (row["total"], row["complete"]) == (4, 3)
    got = {r["a"]: r["ontime_grad"] for r in cleaning.binary_outcome(cleaning.complete_cases(df)).collect()}
    assert got == {1: 1, 4: 0}


def test_prelim_fill_keeps_observed_and_carries_history(spark):
    df = spark.createDataFrame([(1, 2010, 0.9, 0.8, 5), (1, 2011, 0.7, None, 6), (2, 2011, None, 0.5, 7)], "k int, y int, att double, est double, mob int")
    out = cleaning.prelim_fill(df, estimates={"att": "est"}, carried={"mob": "mob"}, history=df, key=["k"], year="y")
    got = {(r["k"], r["y"]): (r["att"], r["att.ACT"], r["mob"]) for r in out.collect()}
    assert got == {(1, 2010): (0.8, 0.9, None), (2, 2011): (0.5, None, None)}


def test_pool_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 3.0)], "k int, b double")
    assert {tuple(r) for r in cohort.pool([a, b]).collect()} == {(1, "x", None), (2, None, 3.0)}
