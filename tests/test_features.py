import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilo.operators import features

C = F.col


def test_model_matrix_columns_and_levels(spark):
    df = spark.createDataFrame([(1, "b", 2, "on"), (2, "a", 3, "off"), (3, "c", 4, "on")], "STUDENT_KEY int, kind string, n int, SCHOOL_YEAR string")
    out = features.model_matrix(df.withColumn("y", C("n") % 2), target="y", keep=["STUDENT_KEY"])
    assert out.columns == ["STUDENT_KEY", "y", "kindb", "kindc", "n"]
    assert [tuple(r) for r in out.orderBy("STUDENT_KEY").collect()] == [(1, 0.0, 1.0, 0.0, 2.0), (2, 1.0, 0.0, 0.0, 3.0), (3, 0.0, 0.0, 1.0, 4.0)]


def test_many_levels(spark):
    df = spark.range(2000).select(F.concat(F.lit("v"), F.lpad(C("id").cast("string"), 4, "0")).alias("s"))
    assert len(features.levels(df, ["s"])["s"]) == 2000
    more = df.union(spark.createDataFrame([("unseen",), (None,), ("v0001",)], "s string"))
    out = features.level_vectors(more, df, "s").collect()
    assert len(out) == 2003 and {r["s_levels"]["size"] for r in out} == {2000}
    at = {}
    for r in out:
        at.setdefault(r["s"], set()).add(tuple(r["s_levels"]["indices"]))
    assert at["unseen"] == at[None] == {()} and len(at["v0001"]) == 1
    assert sorted(i for s, found in at.items() for (i,) in [x for x in found if x]) == list(range(2000))


def test_gram_keeps_digits_with_large_means(spark):
    df = spark.range(1000, numPartitions=7).select((C("id") % 7 + 1e9).alias("a"), (C("id") % 3 - 1e9).alias("b"))
    x = np.array([[r["a"] - 1e9, r["b"] + 1e9] for r in df.collect()])
    centred = x - x.mean(0)
    got = features.gram(df, ["a", "b"], centre=[1e9 + x[:, 0].mean(), -1e9 + x[:, 1].mean()])
    assert np.allclose(got, centred.T @ centred, rtol=1e-6)


def test_find_binary_includes_constants_and_text(spark):
    df = spark.createDataFrame([(1, 0, "x", 1.0, None), (1, 1, "y", 2.0, 4), (1, None, "x", 3.0, 4)], "a int, b int, c string, d double, e int")
    got = {r["column"]: r["is_binary"] for r in features.find_binary(df, df.columns).collect()}
    assert got == {"a": True, "b": True, "c": True, "d": False, "e": True}
    assert features.binary_columns(df, ["d", "a"]) == ["a"]


def test_scaling_and_back_is_identity(spark):
    df = spark.createDataFrame([(i, float(i * i), i % 2, "traindata" if i < 6 else "testdata") for i in range(10)], "id int, x double, b int, split string")
    scaler = features.fit_scaler(df, ["x"], ["b"], split="split")
    scaled = features.standardize(df, scaler, ["x"], binary=["b"])
    train = [r["x"] for r in scaled.where("split = 'traindata'").collect()]
    assert abs(np.mean(train)) < 1e-12 and abs(np.std(train, ddof=1) - 1) < 1e-12
    back = features.unstandardize(scaled, scaler, ["x"], binary=["b"])
    for r, o in zip(back.orderBy("id").collect(), df.orderBy("id").collect()):
        assert abs(r["x"] - o["x"]) < 1e-9 and abs(r["b"] - o["b"]) < 1e-12
    own = features.standardize(df, scaler, ["x"], binary=["b"], per_split="split")
    for r in own.groupBy("split").agg(F.avg("b").alias("m")).collect():
        assert abs(r["m"]) < 1e-12


def test_uncenter_gives_zeros_and_ones(spark):
    df = spark.createDataFrame([(v - 0.3,) for v in (0, 1, 1, 0, 0)], "x double")
    assert sorted(round(r["x"]) for r in features.uncenter(df, ["x"]).collect()) == [0, 0, 0, 1, 1]


def test_split_shares_and_modes(spark):
    df = spark.range(6000).withColumnRenamed("id", "k")
    for mode, train, valid in (("PROD", 0.45, 0.25), ("DEV", 0.25, 0.25)):
        n = {r["split"]: r["count"] for r in features.three_way_split(df, ["k"], mode=mode).groupBy("split").count().collect()}
        assert abs(n["traindata"] / 6000 - train) < 0.03 and abs(n["validdata"] / 6000 - valid) < 0.03
    big = spark.range(70000).withColumnRenamed("id", "k")
    n = {r["split"]: r["count"] for r in features.three_way_split(big, ["k"], mode="PROD").groupBy("split").count().collect()}
    assert abs(n["traindata"] / 70000 - 0.45) < 0.01 and abs(n["validdata"] / 70000 - 0.25) < 0.01


def test_align_fills_with_zero_and_orders(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id int, b double, a double")
    out = features.align_columns(df, ["a", "z", "b"], keep=["id"])
    assert out.columns == ["id", "a", "z", "b"] and tuple(out.first()) == (1, 3.0, 0.0, 2.0)


def test_class_labels_by_training_size(spark):
    df = spark.createDataFrame([(0, "t"), (0, "t"), (1, "t"), (1, "x"), (1, "x"), (1, "x")], "y int, s string")
    out = features.class_labels(df, "y", train=C("s") == "t")
    assert {(r["y"], r["class"]) for r in out.collect()} == {(0, "Grad"), (1, "Non.Grad")}


def test_known_levels_use_most_frequent(spark):
    train = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,), (None,)], "v string")
    new = spark.createDataFrame([("a",), ("q",), (None,)], "v string")
    assert sorted(r["v"] for r in features.known_levels(new, train, "v").collect()) == ["a", "b", "b"]


def test_gram_matches_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    w = rng.uniform(size=300)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, w)], "a double, b double, c double, w double")
    full = np.column_stack([np.ones(300), x])
    assert np.allclose(features.gram(df, ["a", "b", "c"], weight="w", intercept=True), full.T @ (full * w[:, None]))


def test_drop_collinear_keeps_first(spark):
    df = spark.createDataFrame([(float(i), float(i % 3), float(i + i % 3), 0.0, float(i * i)) for i in range(20)], "a double, b double, c double, z double, d double")
    assert features.drop_collinear(df, df.columns).columns == ["a", "b", "d"]
