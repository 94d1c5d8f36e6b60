import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilo.plans import averaging, ensemble, methods, search
from vigilo.plans.control import control
from vigilo.sources import artifacts

C = F.col
COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    n = 600
    x = rng.normal(size=(n, 3))
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-(2.5 * x[:, 0] - x[:, 1] - 0.7)))).astype(int)
    splits = ["traindata", "testdata", "validdata"]
    rows = [(i, *map(float, r), int(v), splits[i % 3]) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y int, split string").persist()


def test_control_modes():
    assert (control("DEV").folds, control("DEV").length, control("DEV").upsample) == (5, 4, "SMOTE")
    assert (control("PROD").folds, control("PROD").length, control("PROD").reps) == (10, 9, 3)
    assert control("TEST").upsample == "NONE"
    with pytest.raises(ValueError):
        control("OTHER")


def test_candidates():
    assert set(methods.candidate_methods(full=True)) == {*methods.CLASSIFIERS, "radial_svm"}
    assert len(methods.candidate_methods(3)) == 3


@pytest.mark.parametrize("method", methods.METHODS)
def test_every_method_finds_the_planted_signal(spark, data, method):
    out = search.model_search(data, COLUMNS, "y", methods=[method], control=control("DEV"), length=1)
    rows = {r["grp"]: r for r in out.collect()}
    assert rows["test"]["status"] == "ok" and rows["test"]["auc"] > 0.8
    assert rows["train"]["elapsedTime"] > 0


def test_search_tunes_and_survives_failures(spark, data):
    out = search.model_search(data, COLUMNS, "y", methods=["glmnet", "no_such"], control=control("DEV"), length=2, folds=2)
    status = {r["method"]: (r["status"], r["auc"] is None) for r in out.collect()}
    assert status["glmnet"] == ("ok", False) and status["no_such"][1]


def test_ensemble_chain(spark, data, tmp_path):
    folded = search.with_folds(data, "id", 3)
    names = ["logistic", "decision_tree"]
    held = ensemble.oof_predictions(folded, COLUMNS, "y", names, key="id", fold="fold", folds=3).persist()
    assert held.count() == 600 and held.columns == ["id", "fold", "y", "p_logistic", "p_decision_tree"]
    weights = {r["model"]: r for r in ensemble.greedy_ensemble(held, "y", ["p_logistic", "p_decision_tree"], rounds=4).collect()}
    assert abs(sum(r["weight"] for r in weights.values()) - 1) < 1e-12
    assert weights["p_logistic"]["auc"] > 0.85
    for kind in ("rf", "gbm"):
        top = ensemble.stacked_ensemble(held, "y", ["p_logistic", "p_decision_tree"], method=kind)
        assert top.transform(held).where("p BETWEEN 0 AND 1").count() == 600
    models = dict(ensemble.fit_models(data, COLUMNS, "y", names))
    models["logistic"] = methods.classifier("logistic", COLUMNS, "y").pipeline.fit(data)
    artifacts.save_model(models["logistic"], str(tmp_path / "m"))
    models["logistic"] = artifacts.load_model(str(tmp_path / "m"))
    scored = ensemble.score_cohort(data, models, {"p_logistic": 0.5, "p_decision_tree": 0.5}, threshold=0.4)
    row = scored.agg(F.min("pred"), F.max("pred"), F.min("se"), F.count("se")).first()
    assert 0 <= row[0] <= row[1] <= 1 and row[2] >= 0 and row[3] == 600


def test_saved_discriminant_scores_alike(spark, data, tmp_path):
    model = methods.classifier("slda", COLUMNS, "y").pipeline.fit(data)
    artifacts.save_model(model, str(tmp_path / "lda"))
    again = artifacts.load_model(str(tmp_path / "lda")).transform(data).select("id", "p")
    assert again.exceptAll(model.transform(data).select("id", "p")).count() == 0


def test_saved_tables_replace_only_their_cohorts(spark, tmp_path):
    path = str(tmp_path / "t")
    for rows in ([(1, 5, "x"), (2, 6, "x")], [(3, 6, "x")]):
        artifacts.save_table(spark.createDataFrame(rows, "v int, grade int, year string"), path)
    assert {(r["v"], r["grade"]) for r in artifacts.load_table(spark, path).collect()} == {(1, 5), (3, 6)}


def test_dissimilarity_and_choice(spark):
    rows = [(1, 0.9, 0.9, 0.1), (1, 0.1, 0.1, 0.9), (0, 0.1, 0.1, 0.1), (0, 0.2, 0.9, 0.9)]
    df = spark.createDataFrame(rows, "y int, p double, q double, r double")
    far = search.model_dissimilarity(df, "y", ["p", "q", "r"])
    got = {(x["model_a"], x["model_b"]): x["distance"] for x in far.collect()}
    assert got == {("p", "q"): 0.5, ("p", "r"): 1.0, ("q", "r"): 1 - 1 / 3}
    assert search.dissimilar_models(far, 2) == ["p", "r"]


def test_imputation_fills_missing_only(spark, data):
    df = search.with_folds(data, "id", 3).withColumn("t", F.when(C("id") % 5 != 0, C("a") * 3 + C("b")))
    df = df.withColumn("c", F.when(C("id") != 7, C("c")))
    out = ensemble.model_impute(df, "t", COLUMNS, fold="fold", folds=3)
    assert out.count() == 600
    worst = out.where("id % 5 = 0").agg(F.max(F.abs(C("t_filled") - (C("a") * 3 + C("b")))).alias("e")).first()["e"]
    assert worst < 0.5
    assert out.where("id % 5 <> 0 AND t_filled <> t").count() == 0


def test_greedy_error_weights_prefers_the_good_model():
    rng = np.random.default_rng(2)
    y = rng.normal(size=100)
    m = np.column_stack([y + rng.normal(size=100), y + rng.normal(size=100) / 10, y])
    assert ensemble.greedy_error_weights(m.T @ m)[1] > 0.8


def test_importance_and_averaging(spark, data):
    model = methods.classifier("rf", COLUMNS, "y").pipeline.fit(data)
    drop = {r["column"]: r["drop"] for r in ensemble.var_importance(data, model, COLUMNS, "y", key="id").collect()}
    assert drop["a"] > drop["b"] > drop["c"]
    tree = {r["column"]: r["weight"] for r in ensemble.tree_importance(model, COLUMNS).collect()}
    assert abs(sum(tree.values()) - 100) < 1e-6 and tree["a"] > tree["c"]
    terms = {(r["term"], r["kind"]): r["value"] for r in averaging.bic_average(data, "y", {c: [c] for c in COLUMNS}).collect()}
    assert terms["a", "inclusion"] > 0.99 > 0.5 > terms["c", "inclusion"]
    kept = {(r["term"], r["kind"]): r["value"] for r in averaging.bic_average(data, "y", {c: [c] for c in COLUMNS}, window=20).collect()}
    assert abs(kept["a", "inclusion"] - terms["a", "inclusion"]) < 0.01


def test_early_warning_tunes_its_base_learners(spark, data, monkeypatch):
    from vigilo.plans import early_warning, workflow

    asked = []

    def build(train, columns, label, *, top, dissimilar, folds, length=1, by=None):
        asked.append(length)
        return workflow.Ensembles({})

    monkeypatch.setattr(workflow, "construct_models", build)
    monkeypatch.setattr(workflow, "save_bundle", lambda *a, **k: None)
    for length, want in ((None, control("DEV").length), (2, 2)):
        more = {} if length is None else {"length": length}
        early_warning.train_models(data.drop("split"), "unused", target="y", key="id", exclude=[], control=control("DEV"), methods=["naive_bayes", "slda"],
                                   grade=8, folds=2, **more)
        assert asked.pop() == want
    folded = search.with_folds(data, COLUMNS, 2)
    fits = ensemble.tune_members(folded, COLUMNS, "y", ["decision_tree"], length=3, fold="fold", folds=2)
    chosen = fits.best["", "decision_tree"]
    assert [s[-1].setting["maxDepth"] for s in fits.models["", "decision_tree"]] == [3, 4, 5]
    assert fits.final()["decision_tree"].setting["maxDepth"] == 3 + chosen


def test_choose_methods_by_budget_and_distance(spark):
    from vigilo.plans import workflow

    rows = [("a", "test", 0.9, 100.0, "ok"), ("a", "train", 0.99, 100.0, "ok"), ("b", "test", 0.8, 4.0, "ok"),
            ("c", "test", 0.7, 900.0, "ok"), ("d", "test", None, 1.0, "Error")]
    results = spark.createDataFrame(rows, search.RESULT_SCHEMA)
    distances = spark.createDataFrame([("p_a", "p_b", 0.4), ("p_a", "p_c", 0.9), ("p_b", "p_c", 0.8)], "model_a string, model_b string, distance double")
    top, far = workflow.choose_methods(results, 5, n=2, distances=distances)
    assert top == ["b", "a"] and far == ["a", "b"]
    assert workflow.choose_methods(results, 5, n=1) == (["b"], [])


def test_four_ensembles_and_raw_predictions(spark, data):
    from vigilo.plans import workflow

    train = workflow.training_rows(data, COLUMNS, "y", control("DEV"), key="id")
    n = {r["y"]: r["count"] for r in train.groupBy("y").count().collect()}
    rare = data.where("split = 'traindata' AND y = 1").count()
    assert n[1] == rare * 3 and n[0] == rare * 4
    built = workflow.construct_models(train, COLUMNS, "y", top=["logistic", "decision_tree"], dissimilar=["slda", "logistic"], folds=2, rounds=3)
    areas = {r["model"]: r["auc"] for r in workflow.ensemble_areas(built.transform(data.where("split = 'validdata'")), "y").collect()}
    assert set(areas) == set(workflow.ENSEMBLES) and max(areas.values()) > 0.85
    out = workflow.raw_predictions(built, data, data.drop("y", "c"), COLUMNS, "y", key="id")
    row = out.agg(F.count("pred"), F.min("pred"), F.max("pred"), F.max("c"), F.min("bestThresh"), F.min("se")).first()
    assert row[0] == 600 and 0 <= row[1] <= row[2] <= 1 and row[3] == 0 and 0 < row[4] < 1 and row[5] >= 0
