"""Batched fits against single ones, brute force and planted data."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vigilo.operators.evaluate import roc_auc
from vigilo.plans import averaging, batched, ensemble, search, workflow
from vigilo.plans.blocks import MISSING_GROUP
from vigilo.plans.fitted import Fitted, fourier_terms, with_scores
from vigilo.plans.methods import METHODS, classifier

COLUMNS = ["a", "b", "c"]
FOLDS = 3


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 900
    x = rng.normal(size=(n, 3)) * [1, 4, 0.2] + [0, 50, 1]
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-(2 * x[:, 0] - 0.3 * (x[:, 1] - 50) - 0.5)))).astype(int)
    rows = [(i, *map(float, r), int(v), f"0{5 + i % 2}") for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, y int, grade string")
    return search.with_folds(df, "id", FOLDS).persist()


def assembled(df):
    return VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(df)


def problems(data):
    return [data.where(F.col("fold") != f) for f in range(FOLDS)] + [data]


@pytest.mark.parametrize("method,mix", [("logistic", None), ("ridge_logistic", 0.0), ("elastic_net", 0.5)])
def test_linear_fits_are_those_of_single_ones(data, method, mix):
    fits = batched.fit_all(data, COLUMNS, "y", [method], folds=["fold"], count=FOLDS, length=2)
    for k, per_problem in enumerate(fits.models["", method]):
        for rows, got in zip(problems(data), per_problem, strict=True):
            reg = got.setting.get("regParam", 0.0)
            want = LogisticRegression(labelCol="y", regParam=reg, elasticNetParam=mix or 0.0, maxIter=300, tol=1e-12).fit(assembled(rows))
            assert np.allclose(got.arrays["weights"], want.coefficients.toArray(), atol=2e-5), (k, reg)
            assert abs(got.arrays["intercept"] - want.intercept) < 2e-3


def test_hinge_loss_is_at_most_that_of_a_single_fit(data):
    fits = batched.fit_all(data, COLUMNS, "y", ["linear_svm"], folds=["fold"], count=FOLDS, length=2)
    x, y = np.array(data.select(*COLUMNS).collect()), np.array([r[0] for r in data.select("y").collect()]) * 2 - 1
    for per_problem in fits.models["", "linear_svm"]:
        got = per_problem[-1]
        reg, sd = got.setting["regParam"], x.std(axis=0, ddof=1)

        def cost(w, b):
            return np.maximum(0, 1 - y * (x @ w + b)).mean() + reg / 2 * ((w * sd) ** 2).sum()

        one = LinearSVC(labelCol="y", regParam=reg, maxIter=200).fit(assembled(data))
        assert cost(got.arrays["weights"], got.arrays["intercept"]) < cost(one.coefficients.toArray(), one.intercept) * 1.03


def test_moment_methods_score_as_single_fits(data):
    fits = batched.fit_all(data, COLUMNS, "y", ["naive_bayes", "slda", "pam"], folds=["fold"], count=FOLDS, length=1)
    x = np.array(data.select(*COLUMNS).collect())
    bayes = NaiveBayes(labelCol="y", modelType="gaussian").fit(assembled(data)).transform(assembled(data))
    want = np.array([r[0] for r in bayes.select(vector_to_array("probability")[1]).collect()])
    assert np.allclose(fits.models["", "naive_bayes"][0][-1].score(x), want, atol=1e-6)
    for name, method in (("slda", "linear_discriminant"), ("pam", "shrunken_centroid")):
        for rows, got in zip(problems(data), fits.models["", method][0], strict=True):
            single = classifier(name, COLUMNS, "y").pipeline.fit(rows).transform(rows)
            mine = got.transform(rows.select("id", *COLUMNS)).select("id", F.col("p").alias("mine"))
            assert single.join(mine, "id").agg(F.max(F.abs(F.col("p") - F.col("mine")))).first()[0] < 1e-6


def test_first_split_is_the_best_one(data):
    fits = batched.fit_all(data, COLUMNS, "y", ["decision_tree"], folds=["fold"], count=FOLDS, length=3)
    x, y, fold = (np.array(data.select(*c).collect()) for c in (COLUMNS, ["y"], ["fold"]))
    y, fold = y[:, 0], fold[:, 0]
    marks = np.array([[v for v in data.selectExpr(f"percentile_approx({c}, array({', '.join(str(k / 32) for k in range(1, 32))}), 10000)").first()[0]] for c in COLUMNS])
    gini = lambda v: 2 * v.mean() * (1 - v.mean()) * len(v) if len(v) else 0.0
    for f in range(FOLDS + 1):
        rows = fold != f
        best = min((gini(y[rows & (x[:, k] <= t)]) + gini(y[rows & (x[:, k] > t)]), k, t) for k in range(3) for t in set(marks[k]))
        for found in fits.models["", "decision_tree"]:
            a = found[f].arrays
            at, cut = a["feature"][0], a["threshold"][0]
            assert abs(gini(y[rows & (x[:, at] <= cut)]) + gini(y[rows & (x[:, at] > cut)]) - best[0]) < 1e-9
    deep = [found[-1] for found in fits.models["", "decision_tree"]]
    leaves = [len(set(np.round(m.score(x), 12))) for m in deep]
    assert leaves[0] <= 8 < leaves[2]
    ones = [sum(abs(m.score(x) - y)) for m in deep]
    assert ones[0] > ones[1] > ones[2]


def test_every_method_learns_at_every_setting_and_scores_held_out_rows(spark, data):
    fits = batched.fit_all(data, COLUMNS, "y", METHODS, folds=["fold"], count=FOLDS, length=2)
    tuned = fits.tune(data)
    assert tuned.where("value > 0.8").count() == tuned.count() >= 20
    held = fits.held_out(data, keep=["id", "fold"]).persist()
    assert held.count() == 900 and set(held.columns) == {"id", "fold", "rep", "held_fold", "y", *[f"p_{m}" for m in METHODS]}
    rows = data.where("fold = 1").select("id", *COLUMNS).orderBy("id").collect()
    x = np.array([r[1:] for r in rows])
    for m in METHODS:
        want = fits.models["", m][fits.best["", m]][1].score(x)
        got = [r[0] for r in held.where("fold = 1").orderBy("id").select(f"p_{m}").collect()]
        assert np.allclose(got, want) and np.isfinite(want).all() and want.min() >= 0 and want.max() <= 1
    for m in fits.final().values():
        again = Fitted.from_row(*m.to_row())
        assert np.array_equal(again.score(x), m.score(x))


def test_groups_are_fitted_as_if_alone(spark, data):
    names = ["logistic", "decision_tree", "naive_bayes", "component_logistic", "radial_svm", "hinge_logistic"]
    together = batched.fit_all(data, COLUMNS, "y", names, folds=["fold"], count=FOLDS, length=1, group="grade")
    assert together.groups == ["05", "06"]
    x = np.array(data.select(*COLUMNS).collect())
    for g in together.groups:
        alone = batched.fit_all(data.where(F.col("grade") == g), COLUMNS, "y", names, folds=["fold"], count=FOLDS, length=1)
        for m in names:
            for p in range(FOLDS + 1):
                assert np.allclose(together.models[g, m][0][p].score(x), alone.models["", m][0][p].score(x), atol=1e-6), (g, m, p)


def test_odd_rows_and_one_class(spark, data):
    odd = data.unionByName(data.limit(5).withColumn("a", F.lit(None).cast("double"))).unionByName(data.limit(5).withColumn("y", F.lit(None).cast("int")))
    odd = odd.unionByName(data.limit(3).withColumn("grade", F.lit(None).cast("string")).withColumn("y", F.lit(1)))
    odd = odd.withColumn("same", F.lit(3.0))
    fits = batched.fit_all(odd, [*COLUMNS, "same"], "y", METHODS, folds=["fold"], count=FOLDS, length=1, group="grade")
    assert len(fits.groups) == 3
    lone = fits.final(MISSING_GROUP)
    assert all(m.score(np.zeros((2, 4))).tolist() == [1.0, 1.0] for m in lone.values())
    scored = with_scores(odd, {f"p_{m}": f for m, f in fits.final("05").items()})
    assert scored.where("a is null and p_logistic is null").count() == 5 and scored.where("a is not null and p_radial_svm is null").count() == 0
    empty = batched.fit_all(odd.where("false"), COLUMNS, "y", ["logistic", "rf"], folds=["fold"], count=FOLDS)
    assert empty.groups == []


def test_radial_machine_finds_rings_and_its_kernel_is_close(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 2))
    y = (np.hypot(x[:, 0], x[:, 1]) > 1.1).astype(int)
    df = search.with_folds(spark.createDataFrame([(i, float(a), float(b), int(v)) for i, ((a, b), v) in enumerate(zip(x, y))], "id int, a double, b double, y int"), "id", FOLDS)
    fits = batched.fit_all(df, ["a", "b"], "y", ["svmRadialCost", "svmLinear"], folds=["fold"], count=FOLDS, length=4)
    fits.tune(df)
    held = fits.held_out(df, keep=["id"]).persist()
    area = {m: roc_auc(held, f"p_{m}", "y").first()["auc"] for m in ("radial_svm", "linear_svm")}
    assert area["radial_svm"] > 0.95 > 0.7 > area["linear_svm"]
    assert len({(s[0].setting["width"], s[0].setting["regParam"]) for s in fits.models["", "radial_svm"]}) == 4
    basis = batched.radial_basis(np.zeros(2), np.ones(2), 0.5, features=4096)
    a = basis.arrays
    terms = fourier_terms(x[:60], a["centre"], a["scale"], a["directions"], a["phases"])
    exact = np.exp(-0.5 * ((x[:60, None] - x[None, :60]) ** 2).sum(axis=2))
    assert np.abs(terms @ terms.T - exact).max() < 0.08


def test_repetitions_and_metrics(spark):
    rng = np.random.default_rng(9)
    y = np.arange(600) % 2
    u = rng.uniform(size=600)
    far = np.where(y == 1, np.where(u < 0.5, 2.0, 1.0), np.where(u < 0.5, 0.0, 1.0))
    near = np.where(y == 1, np.where(u < 0.8, 1.0, 0.0), np.where(u < 0.8, 0.0, 1.0))
    df = spark.createDataFrame([(i, float(a), float(b), int(v)) for i, (a, b, v) in enumerate(zip(far, near, y))], "id int, a double, b double, y int")
    df, names = search.with_repeated_folds(df, "id", 10, 3)
    assert names == ["fold", "fold_2", "fold_3"] and df.select(F.countDistinct("fold", "fold_2")).first()[0] > 90
    one = lambda w: [Fitted("m", "linear", ["a", "b"], {}, {"weights": np.array(w), "intercept": np.array(0.0)})] * 31
    fits = batched.Fits(["a", "b"], "y", names, 10, None, {("", "m"): [one([0.0, 0.1]), one([0.1, 0.0])]}, {})
    assert fits.held_out(df, keep=["id"]).groupBy("id").count().where("count = 3").count() == 600
    fits.tune(df, "ROC")
    assert fits.best == {("", "m"): 1}
    fits.tune(df, "Dist")
    fits.best.clear()
    fits.tune(df, "Dist")
    assert fits.best == {("", "m"): 0}
    made = batched.fit_all(df, ["a", "b"], "y", ["logistic"], folds=names, count=10)
    assert len(made.models["", "logistic"][0]) == 31
    with pytest.raises(ValueError):
        fits.tune(df, "other")


def test_greedy_weights_of_groups(spark):
    rng = np.random.default_rng(4)
    rows = []
    for g, good in (("x", 0), ("y", 1)):
        for i in range(300):
            v = i % 2
            scores = rng.uniform(size=3)
            scores[good] = 0.5 * scores[good] + 0.5 * v
            rows.append((g, v, *map(float, scores)))
    df = spark.createDataFrame(rows, "g string, y int, p double, q double, r double")
    got = ensemble.greedy_ensemble(df, "y", ["p", "q", "r"], group="g", rounds=5).collect()
    for g, good in (("x", "p"), ("y", "q")):
        mine = {r["model"]: r for r in got if r["g"] == g}
        assert abs(sum(r["weight"] for r in mine.values()) - 1) < 1e-12 and max(mine, key=lambda m: mine[m]["weight"]) == good
        mean = sum(F.col(m) * r["weight"] for m, r in mine.items())
        area = roc_auc(df.where(F.col("g") == g).withColumn("s", F.round(mean * ensemble.AREA_STEPS)), "s", "y").first()["auc"]
        assert abs(area - mine[good]["auc"]) < 1e-3
    only = ensemble.greedy_ensemble(df, "y", ["p", "q", "r"], group="g", allowed={"x": ["r"], "y": []}).collect()
    assert [(r["g"], r["model"], r["weight"]) for r in only] == [("x", "r", 1.0)]


def test_a_bundle_is_read_back_by_its_path(spark, data, tmp_path):
    split = data.withColumn("split", F.when(F.col("id") % 3 == 0, "validdata").otherwise("traindata"))
    train = split.where("split = 'traindata'")
    built = workflow.construct_models(train, COLUMNS, "y", top={"05": ["logistic"], "06": ["naive_bayes", "decision_tree"]},
                                      dissimilar={"05": ["slda"], "06": ["logistic"]}, folds=2, rounds=3, by="grade")
    valid = split.where("split = 'validdata'")
    chosen = workflow.choose_ensembles(built, valid, "y")
    assert set(chosen) == {"05", "06"} and all(0 < t < 1 for _, t in chosen.values())
    scaler = spark.createDataFrame([("a", "continuous", 0.0, 1.0)], "column string, kind string, mean double, std double")
    workflow.save_bundle(built, str(tmp_path), scaler=scaler, valid=valid, columns=COLUMNS, binary=["c"], levels={"t": ["x", "y"]}, label="y", chosen=chosen)
    again = workflow.load_bundle(spark.newSession(), str(tmp_path))
    assert (again.columns, again.binary, again.levels, again.label, again.chosen, again.built.group) == (COLUMNS, ["c"], {"t": ["x", "y"]}, "y", chosen, "grade")
    first, second = (workflow.best_scores(e, chosen, data, ["id", "grade"]) for e in (built, again.built))
    assert sorted(first.collect()) == sorted(second.collect())
    unknown = workflow.best_scores(built, chosen, data.withColumn("grade", F.lit("99")), ["id"])
    assert unknown.where("pred is null and bestThresh is null").count() == 900
    assert math.isclose(roc_auc(first.join(data.select("id", "y"), "id"), "pred", "y").first()["auc"], 0.9, abs_tol=0.1)


def test_leaps_find_what_all_subsets_find():
    rng = np.random.default_rng(2)
    n, m = 400, 9
    x = rng.normal(size=(n, m)) @ (np.eye(m) + 0.3 * rng.normal(size=(m, m)))
    y = x[:, 0] - 0.5 * x[:, 3] + 0.2 * x[:, 5] + rng.normal(size=n)
    rows = np.column_stack([np.ones(n), x, y])
    products, groups, penalty, slack = rows.T @ rows, [[0], [1, 2], [3], [4], [5, 6], [7], [8]], math.log(n), 6.0

    def value(kept):
        at = [0, *[1 + c for g in kept for c in groups[g]]]
        beta = np.linalg.solve(products[np.ix_(at, at)], products[at, -1])
        return products[-1, -1] - beta @ products[at, -1] + penalty * len(at)

    every = [tuple(g for g in range(7) if mask >> g & 1) for mask in range(1, 128)]
    whole = value(tuple(range(7))) - penalty * (m + 1)
    low = min(map(value, every))
    found, _ = averaging.leaps(products, groups, whole, penalty, slack)
    assert sorted(found) == sorted(k for k in every if value(k) <= low + slack + 1e-9)
    wide = rng.normal(size=(2000, 16))
    rows = np.column_stack([np.ones(2000), wide, wide[:, :4] @ [1, 1, 1, 1] + rng.normal(size=2000)])
    found, solved = averaging.leaps(rows.T @ rows, [[k] for k in range(16)], 0.0, math.log(2000), 4 * math.log(20))
    assert solved < 8000 and (0, 1, 2, 3) in found


def test_window_keeps_the_weights_that_matter(spark, data):
    groups = {c: [c] for c in COLUMNS}
    whole = {(r["term"], r["kind"]): r["value"] for r in averaging.bic_average(data, "y", groups).collect()}
    kept = {(r["term"], r["kind"]): r["value"] for r in averaging.bic_average(data, "y", groups, window=1000).collect()}
    assert all(abs(whole[k] - kept[k]) < 0.01 * (1 + abs(whole[k])) for k in whole)
    assert whole["a", "inclusion"] > 0.99 and averaging.bic_average(data.where("y = 1"), "y", groups).count() == 0
