"""One key or value holding a third of the rows, and tables too large to broadcast."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vigilo.operators import balance, cohort, evaluate, features, ordering, peers
from vigilo.functions import fixed

C = F.col


@pytest.fixture(params=[False, True], ids=["broadcast", "shuffled"])
def joins(request, spark):
    if request.param:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def enrolments(n=3000):
    rng = random.Random(9)
    codes = ["DE", "HSC", "X", None]
    return [
        (0 if i % 3 == 0 else rng.randint(1, 400), dt.date(2009, 1, 1) + dt.timedelta(days=rng.randint(0, 600)), rng.choice(codes))
        for i in range(n)
    ]


def test_outcome_of_a_hot_key(spark, joins):
    rows = enrolments()
    e = spark.createDataFrame(rows, "k int, ended date, code string").withColumn("wy", F.year("ended"))
    members = e.select("k").distinct().withColumn("h", F.lit(2012))
    d = spark.createDataFrame([(1, 2012)] * 1500 + [(2, 2013)], "k int, dy int")
    out = cohort.outcome_label(members, d, e, key="k", horizon="h", diploma_year="dy", end_date="ended", withdraw_year="wy", code="code")
    want = []
    for key in {k for k, _, _ in rows}:
        last = max(x for k, x, _ in rows if k == key)
        for k, x, code in rows:
            if k == key and x == last:
                label = {1: fixed.ON_TIME, 2: fixed.LATE}.get(key) or {"DE": fixed.UNKNOWN_EXIT, "HSC": fixed.LATE}.get(code, fixed.NON_GRAD)
                want.append((key, label, {1: "Yes", 2: "No"}.get(key)))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)


def test_latest_rows_of_a_hot_key(spark, joins):
    rows = enrolments()
    out = cohort.latest_rows(spark.createDataFrame(rows, "k int, ended date, code string"), ["k"], "ended")
    last = {}
    for k, x, _ in rows:
        last[k] = max(x, last.get(k, x))
    assert out.count() == len(rows)
    assert out.where("maxObsFlag = 'Yes'").count() == sum(x == last[k] for k, x, _ in rows)


def test_peers_with_one_dominant_school(spark, joins):
    df = spark.range(900).select(
        F.when(C("id") % 3 == 0, "big").when(C("id") % 7 == 0, None).otherwise((C("id") % 50).cast("string")).alias("SCHOOL_KEY"),
        C("id").cast("double").alias("READ_SS"), C("id").cast("double").alias("MATH_SS"), F.lit(1).alias("incCount"),
        F.lit(1).alias("STUDENT_ANNUAL_ABSENCES"), F.lit(10).alias("STUDENT_ANNUAL_ENROLLMENT_DAYS"), F.lit("White").alias("STUDENT_RACE"),
        F.lit("No").alias("STUDENT_SPECIAL_ED_INDICATOR"), F.lit("N").alias("STUDENT_FOODSERVICE_ELIG_CODE"),
    )
    out = peers.peer_enriched(df, ["SCHOOL_KEY"])
    assert out.count() == 900 and out.where("cohort_size IS NULL").count() == 0
    assert out.where("SCHOOL_KEY = 'big'").agg(F.min("cohort_size")).first()[0] == 300


def test_running_sums_and_areas_without_broadcast(spark, joins):
    df = spark.range(600).select(
        F.when(C("id") % 2 == 0, "a").alias("g"), F.when(C("id") % 3 == 0, 0.5).otherwise(C("id") / 600).alias("s"), (C("id") % 5 == 0).cast("int").alias("y")
    )
    ranked = ordering.row_numbers(df.withColumn("k", F.monotonically_increasing_id()), "k", "r", by=["g"])
    assert ranked.groupBy("g").agg(F.max("r").alias("m"), F.count_distinct("r").alias("n")).where("m = 300 AND n = 300").count() == 2
    rows = df.collect()
    for r in evaluate.roc_auc(df, "s", "y", by=["g"]).collect():
        mine = [(x["s"], x["y"]) for x in rows if x["g"] == r["g"]]
        pos, neg = [s for s, y in mine if y], [s for s, y in mine if not y]
        assert abs(r["auc"] - sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)) < 1e-12


def test_levels_and_balance_without_broadcast(spark, joins):
    df = spark.range(300).select("id", F.when(C("id") % 3 == 0, "hot").otherwise((C("id") % 11).cast("string")).alias("v"), (C("id") % 4 == 0).cast("int").alias("y"))
    out = features.known_levels(df, df.where("v <> '5'"), "v")
    assert out.count() == 300 and out.where("v = '5'").count() == 0
    assert {r["count"] for r in balance.upsample(df, "y", "id").groupBy("y").count().collect()} == {225}
