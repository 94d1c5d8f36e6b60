import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigilo.operators import ordering
from vigilo.operators.groups import with_group_stats

C = F.col


def test_prefix_sums_match_a_plain_loop(spark):
    rng = random.Random(3)
    data = [(g, v, rng.randint(1, 9)) for g in ("a", "b", None) for v in rng.sample(range(500), 200)]
    df = ordering.with_value_buckets(spark.createDataFrame(data, "g string, v int, n long"), "v")
    out = ordering.prefix_sums(df, "v", {"n": "upto"}, by=["g"], totals={"n": "all"}, previous="below")
    got = {(r["g"], r["v"]): (r["upto"], r["all"], r["below"]) for r in out.collect()}
    for g in ("a", "b", None):
        total, below = 0, None
        everything = sum(n for h, _, n in data if h == g)
        for _, v, n in sorted(x for x in data if x[0] == g):
            total += n
            assert got[g, v] == (total, everything, below)
            below = v
    assert len(got) == len(data)


def test_one_hot_value_is_one_row_of_counts(spark):
    df = spark.range(3000).select(F.when(C("id") % 3 == 0, 7).otherwise(C("id")).alias("v"))
    counts = ordering.value_counts(df, "v")
    assert counts.where("v = 7").first()["n"] >= 1000
    assert ordering.quantiles(df, "v", [0.5]).first()["q0"] == np.quantile([7 if i % 3 == 0 else i for i in range(3000)], 0.5)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-100, 100).map(lambda x: round(x, 1)), min_size=1, max_size=40))
def test_quantiles_are_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = ordering.quantiles(df, "v", [0.1, 0.5, 0.9]).first()
    assert np.allclose(list(row), np.quantile(values, [0.1, 0.5, 0.9]))
    limit = values[0]
    assert df.agg(ordering.median_exceeds(C("v"), limit).alias("m")).first()["m"] == (np.median(values) > limit)


def test_row_numbers_and_hash_ranks(spark):
    df = spark.createDataFrame([(i * 3 % 101, i % 2) for i in range(101)], "k int, g int")
    numbered = ordering.row_numbers(df, "k", "r", by=["g"]).collect()
    for g in (0, 1):
        keys = sorted(r["k"] for r in numbered if r["g"] == g)
        assert {r["k"]: r["r"] for r in numbered if r["g"] == g} == {k: i + 1 for i, k in enumerate(keys)}
    ranked = ordering.hash_ranks(df, F.md5(C("k").cast("string")), "r", tie="k")
    assert sorted(r["r"] for r in ranked.collect()) == list(range(1, 102))


def test_repeat_rows_uses_short_arrays(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 10)], "k string, n int")
    out = ordering.repeat_rows(df, C("n"), "i", chunk=4)
    assert sorted((r["k"], r["i"]) for r in out.collect()) == [("b", 0)] + [("c", i) for i in range(10)]


def test_row_numbers_of_repeated_keys(spark):
    rows = [(-2, k) for k in range(300)] + [(k, k) for k in range(50)] + [(None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "key long, v int")
    got = ordering.row_numbers(df, "key", "n").collect()
    assert sorted(r["n"] for r in got) == list(range(1, 353))
    hot = [r["n"] for r in got if r["key"] == -2]
    assert len(hot) == 300 and max(hot) - min(hot) == 299
    by = sorted((r["n"], r["key"]) for r in got if r["key"] is not None and r["key"] >= 0)
    assert [k for _, k in by] == list(range(50))


def test_group_stats_join_by_key(spark):
    df = spark.range(10).select("id", (C("id") % 3).alias("g"))
    out = with_group_stats(df, ["g"], {"n": F.count(F.lit(1))})
    assert {(r["g"], r["n"]) for r in out.collect()} == {(0, 4), (1, 3), (2, 3)}
    with pytest.raises(Exception):
        with_group_stats(df, ["missing"], {"n": F.count(F.lit(1))}).count()


def test_group_tables_do_not_move_the_rows(spark):
    df = spark.range(5000).select("id", (C("id") % 3).alias("g"))
    plan = with_group_stats(df, ["g"], {"n": F.count(F.lit(1))})._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_row_numbers_shuffle_the_rows_once(spark):
    df = spark.range(5000).select((C("id") * 7919 % 5000).alias("k"), (C("id") % 3).alias("g"))
    out = ordering.row_numbers(df, "k", "r", by=["g"])
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = {g: sorted((r["k"], r["r"]) for r in out.where(C("g") == g).collect()) for g in (0, 1, 2)}
    assert all([r for _, r in x] == list(range(1, len(x) + 1)) for x in got.values()) and sum(map(len, got.values())) == 5000


def test_row_numbers_of_missing_and_of_very_near_keys(spark):
    big = 2**60  # as doubles these keys are one; the middle one fills a third of the rows
    rows = [(big + i, 0) for i in range(3)] + [(big + 1, i) for i in range(100)] + [(i, i) for i in range(190)] + [(None, i) for i in range(7)]
    got = sorted(((r["n"], r["key"]) for r in ordering.row_numbers(spark.createDataFrame(rows, "key long, v int"), "key", "n").collect()), key=lambda x: x[0])
    keys = [None] * 7 + sorted(k for k, _ in rows if k is not None)
    assert got == [(i + 1, k) for i, k in enumerate(keys)]
    odd = spark.createDataFrame([(float("nan"),), (None,), (2.0,), (1.0,), (None,)], "key double")
    assert [r["key"] for r in ordering.row_numbers(odd, "key", "n").orderBy("n").limit(4).collect()] == [None, None, 1.0, 2.0]
