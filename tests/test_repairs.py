"""Cases that once went wrong: NaN, missing keys, several cohorts in one table."""

import math

from pyspark.sql import functions as F

from vigilo.operators import cleaning, cohort, evaluate, risk, robust
from vigilo.plans import workflow


def test_nan_is_missing_in_both(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None), (None, 2.0)], "a int, b double")
    assert cleaning.complete_cases(df).count() == 1
    assert tuple(cleaning.complete_case_counts(df).first()) == (4, 1)


def test_missing_keys_have_a_latest_row(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), (1, 2), (1, None)], "k int, d int")
    got = {(r["k"], r["d"]): r["maxObsFlag"] for r in cohort.latest_rows(df, ["k"], "d").collect()}
    assert got == {(None, 1): "No", (None, 3): "Yes", (1, 2): "No", (1, None): "Yes"}


def test_mobility_counts(spark):
    rows = [(1, "d1", "s1"), (1, "d1", "s1"), (1, "d2", "s2"), (1, None, "s3"), (2, None, None)]
    got = cohort.mobility_counts(spark.createDataFrame(rows, "k int, d string, s string"), ["k"], district="d", school="s")
    assert sorted(map(tuple, got.collect())) == [(1, 2, 3, 4), (2, 0, 0, 1)]


def test_ranks_and_bands_are_those_of_the_cohort(spark):
    rows = [(g, float(v + 100 * (g or 0)), v) for g in (1, 2, None) for v in range(1, 11)]
    df = spark.createDataFrame(rows, "g int, v double, place int")
    got = evaluate.ecdf_rank(df, {"v": "rank"}, by=["g"])
    for r in got.collect():
        assert r["rank"] == math.floor(r["place"] / 10 * 100)
    marks = spark.createDataFrame(
        [(1, 1.0, 0.0), (1, 2.0, 0.0), (1, 3.0, 0.0), (2, 3.0, 0.0), (2, 3.0, 1.0), (2, 5.0, 0.0), (2, 6.0, 0.0)], "g int, incCount double, daysRemoved double")
    bands = [(r["g"], r["incCount"], r["daysRemoved"], r["discipline"]) for r in risk.discipline_band(marks, by=["g"]).collect()]
    assert sorted(bands) == [(1, 1.0, 0.0, "Low"), (1, 2.0, 0.0, "Moderate"), (1, 3.0, 0.0, "High"), (2, 3.0, 0.0, "Low"), (2, 3.0, 1.0, "Moderate"),
                             (2, 5.0, 0.0, "Moderate"), (2, 6.0, 0.0, "High")]


def test_assessment_limits_are_those_of_the_cohort(spark):
    rows = [(g, "Moderate", 10.0 * g, 10.0 * g + d) for g in (1, 2) for d in (-1.0, 0.0, 1.0)] + [(1, "Low", 20.0, 20.0), (2, "Low", 10.0, 10.0)]
    df = spark.createDataFrame(rows, "g int, flag string, MATH_SS double, READ_SS double")
    got = {(r["g"], r["flag"], r["MATH_SS"]): r["assessments"] for r in risk.assessment_band(df, by=["g"]).where("flag = 'Low'").collect()}
    assert got == {(1, "Low", 20.0): "Low", (2, "Low", 10.0): "High"}


def test_target_is_the_smaller_training_class(spark):
    df = spark.createDataFrame([(1, "traindata")] * 8 + [(0, "traindata")] * 3 + [(0, "testdata")] * 9, "y int, split string")
    assert workflow.smaller_class(df.where("split = 'traindata'"), "y") == 0
    assert workflow.smaller_class_target(df, "y").where(F.col("target") != 1 - F.col("y")).count() == 0


def test_discipline_of_the_whole_table_and_of_odd_groups(spark):
    rows = [("a", 0, 0.0), ("a", 2, 1.0), ("a", 3, 5.0), ("a", None, None), ("b", 4, 0.0), (None, 1, 0.0), (None, 2, 0.0), ("c", None, 2.0)]
    df = spark.createDataFrame(rows, "g string, incCount int, daysRemoved double")
    grouped = {(r["g"], r["incCount"]): r["discipline"] for r in risk.discipline_band(df, by=["g"]).collect()}
    assert grouped == {("a", 0): "Low", ("a", 2): "Moderate", ("a", 3): "High", ("a", None): "Low", ("b", 4): "Low", (None, 1): "Low", (None, 2): "Moderate", ("c", None): "Low"}
    whole = {(r["g"], r["incCount"]): r["discipline"] for r in risk.discipline_band(df).collect()}
    assert whole[("a", 0)] == "Low" and whole[(None, 1)] == "Moderate" and whole[("b", 4)] == "High"


def test_one_cluster_has_no_robust_variance(spark):
    df = spark.createDataFrame([(float(k), k % 2, 1) for k in range(9)], "x double, y int, g int")
    out = robust.robust_vcov(df, ["x"], "y", "g", coefficients=[0.1], intercept=0.0).collect()
    assert len(out) == 4 and all(r["value"] is None for r in out)


def test_mobility_counts_in_one_grouping(spark):
    """Each place is counted in the pass that reads the enrolments; missing places and keys stay apart from the sets' own gaps."""
    rows = [(k, d, s) for k in (1, 2, None) for d in ("a", "b", None) for s in (7, None) for _ in range(2)] + [(3, None, None)]
    df = spark.createDataFrame(rows, "k int, d string, s int")
    out = cohort.mobility_counts(df, ["k"], district="d", school="s")
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 2, 1, 12), (2, 2, 1, 12), (3, 0, 0, 1), (None, 2, 1, 12)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2
