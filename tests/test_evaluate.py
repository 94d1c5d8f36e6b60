import math
import random

import numpy as np
from pyspark.sql import functions as F

from vigilo.operators import evaluate, quality, ranking, robust

C = F.col


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def scores(seed=1, n=400):
    rng = random.Random(seed)
    return [(round(rng.random() * 0.6 + 0.3 * (y := rng.randint(0, 1)), 2), y) for _ in range(n)]


def test_auc_counts_ties_half_and_mirrors(spark):
    rows = scores()
    df = spark.createDataFrame(rows, "s double, y int")
    auc = evaluate.roc_auc(df, "s", "y").first()["auc"]
    assert abs(auc - brute_auc(rows)) < 1e-12
    mirrored = evaluate.roc_auc(df.withColumn("s", -C("s")), "s", "y").first()["auc"]
    assert abs(auc + mirrored - 1) < 1e-12


def test_curve_and_threshold_match_brute_force(spark):
    rows = scores(2)
    df = spark.createDataFrame(rows, "s double, y int")
    values = sorted({s for s, _ in rows})
    cuts = [-math.inf, *[(a + b) / 2 for a, b in zip(values, values[1:])], math.inf]
    p = sum(y for _, y in rows)
    n = len(rows) - p
    expected = {}
    for t in cuts:
        sens = sum(1 for s, y in rows if y == 1 and s > t) / p
        spec = sum(1 for s, y in rows if y == 0 and s <= t) / n
        expected[t] = (sens, spec)
    got = {r["threshold"]: (r["sensitivity"], r["specificity"]) for r in evaluate.roc_curve(df, "s", "y").collect()}
    assert got.keys() == expected.keys()
    assert all(np.allclose(got[t], expected[t]) for t in cuts)
    prev = p / (p + n)
    ratio = (1 - prev) / prev
    best = min(cuts, key=lambda t: ((1 - expected[t][0]) ** 2 + ratio * (1 - expected[t][1]) ** 2, t))
    assert evaluate.best_threshold(df, "s", "y").first()["threshold"] == best


def test_one_class_gives_no_area(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert evaluate.roc_auc(df, "s", "y").first()["auc"] is None


def test_ecdf_rank_matches_brute_force(spark):
    rng = random.Random(5)
    values = [rng.choice([None, *range(40)]) for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v int")
    out = {r["i"]: r["r"] for r in evaluate.ecdf_rank(df, {"v": "r"}).collect()}
    known = [v for v in values if v is not None]
    for i, v in enumerate(values):
        want = None if v is None else math.trunc(sum(k <= v for k in known) / len(known) * 100)
        assert out[i] == want


def test_confusion_at_threshold_is_called(spark):
    df = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.4, 1), (0.1, 0)], "s double, y int")
    row = evaluate.confusion(df, "s", "y", F.lit(0.5)).first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (1, 1, 1, 1) and row["kappa"] == 0


def test_group_interval(spark):
    df = spark.createDataFrame([("a", float(v)) for v in range(9)], "g string, v double")
    row = evaluate.group_ci(df, "g", "v").first()
    half = 1.1503493803760079 * np.std(range(9), ddof=1) / 3
    assert np.allclose([row["lower"], row["mean"], row["upper"]], [4 - half, 4, 4 + half])


def test_error_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    y = rng.normal(size=200)
    e = y + rng.normal(size=200) / 5
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, e)], "y double, e double")
    row = evaluate.error_quantiles(df, "y", "e").first()
    assert np.allclose([row["q10"], row["q90"]], np.quantile(y - e, [0.1, 0.9]) / (y.max() - y.min()))


def test_robust_variance_matches_numpy(spark):
    rng = np.random.default_rng(4)
    n = 240
    x = np.column_stack([np.ones(n), rng.normal(size=(n, 2))])
    cluster = rng.integers(0, 12, n)
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-x @ [0.2, 0.5, -0.4]))).astype(float)
    beta = np.array([0.1, 0.4, -0.3])
    df = spark.createDataFrame([(float(a), float(b), float(v), int(c)) for a, b, v, c in zip(x[:, 1], x[:, 2], y, cluster)], "a double, b double, y double, c int")
    got = {(r["row"], r["col"]): r["value"] for r in robust.robust_vcov(df, ["a", "b"], "y", "c", coefficients=beta[1:], intercept=beta[0]).collect()}
    mu = 1 / (1 + np.exp(-x @ beta))
    u = np.stack([((y - mu)[:, None] * x)[cluster == c].sum(0) for c in range(12)])
    bread = np.linalg.inv(x.T @ (x * (mu * (1 - mu))[:, None]))
    m, k = len(set(cluster)), 3
    want = (m / (m - 1)) * ((n - 1) / (n - k - 1)) * bread @ u.T @ u @ bread
    names = ["(Intercept)", "a", "b"]
    assert np.allclose([[got[i, j] for j in names] for i in names], want)


def test_prediction_variance(spark):
    v = [[1.0, 0.2], [0.2, 0.5]]
    row = robust.prediction_variance(spark.createDataFrame([(3.0,)], "a double"), ["a"], v, coefficients=[2.0], intercept=1.0).first()
    assert row["fit"] == 7.0 and abs(row["se_fit"] - (1 + 2 * 0.2 * 3 + 0.5 * 9)) < 1e-12


def test_rankings(spark):
    df = spark.createDataFrame([("a", 0.9, 100.0), ("b", 0.8, 4.0), ("c", None, 1.0), ("b", 0.8, 4.0), ("d", 0.7, 500.0)], "m string, auc double, t double")
    eff = ranking.efficiency(C("auc"), C("t"))
    assert [r["m"] for r in ranking.efficiency_topn(df, "m", efficiency_col=eff, n=2).collect()] == ["b", "a"]
    within = ranking.budget_topn(df, "m", elapsed="t", efficiency_col=eff, grade=5, n=8)
    assert [r["m"] for r in within.collect()] == ["b", "a", "c"]
    ends = ranking.topk_distinct(df, "auc", "m", k=1).collect()
    assert {(r["end"], r["m"]) for r in ends} == {("top", "a"), ("bottom", "d")}
    ok = {r["m"]: r["succeeded"] for r in ranking.search_summary(df, "m", "auc").collect()}
    assert ok == {"a": True, "b": True, "c": False, "d": True}


def test_quality_checks(spark):
    df = spark.createDataFrame([("High", 1.0), ("Low", 3.0), ("Low", None)], "flag string, v double")
    checks = [
        quality.columns_match(df, ["flag", "v"]), quality.rows(2), quality.category("flag", "Low", 2), quality.nulls("v", 1, strict=False),
        quality.statistic("median", "v", 2, 2), quality.statistic("max", "v", 3, 3), quality.categories("flag", 3),
    ]
    got = {r["check"]: r["passed"] for r in quality.quality_checks(df, checks).collect()}
    assert got == {"columns": True, "rows": True, "flag=Low": False, "nulls(v)": True, "median(v)": True, "max(v)": True, "categories(flag)": False}
