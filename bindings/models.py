"""Model search, ensembles, scoring and imputation on the customer features.

These are checked by row counts here and by unit tests on planted data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import base as b
from vigilo.operators import balance, evaluate, features, robust
from vigilo.plans import averaging, ensemble, search, workflow
from vigilo.plans.control import control
from vigilo.plans.methods import candidate_methods
from vigilo.sources.tables import load, stage

C = F.col
QUERIES = {}
ORACLE = {}
BASE_MODELS = candidate_methods()
FOLDS = 10
LENGTH = control("DEV").length
#: Settings each base model is tuned over for its held-out predictions, whatever the mode.
FULL_LENGTH = 16


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def prepared(spark, d):
    """Split and scaled features, written down once because every fit reads them."""
    rows = features.three_way_split(b.features(spark, d), ["id"], mode="PROD")
    scaler = features.fit_scaler(rows, b.CONTINUOUS, ["flagged"], split="split")
    scaled = features.standardize(rows, scaler, b.CONTINUOUS, binary=["flagged"])
    return stage(scaled.select("id", "y", "split", *b.FEATURES), "features")


def _folded(spark, d):
    return search.with_folds(prepared(spark, d), "id", FOLDS)


def _members(spark, d, length=LENGTH):
    """All base models tuned and fitted once, with their held-out scores."""
    rows = _folded(spark, d)
    train = rows.where("split = 'traindata'")
    fits = ensemble.tune_members(train, b.FEATURES, "y", BASE_MODELS, fold="fold", folds=FOLDS, length=length)
    held = stage(ensemble.held_scores(fits, train, BASE_MODELS, key="id", fold="fold"), "held")
    return rows, fits.final(), held


_SCORES = [f"p_{m}" for m in BASE_MODELS]


@query("model_search")
def model_search(spark, d):
    """Every candidate method on rows balanced with synthetic minority rows."""
    rows = prepared(spark, d)
    train = rows.where("split = 'traindata'")
    balanced = stage(balance.smote(train, b.FEATURES, "y", "id", minority=1), "balanced")
    return search.model_search(
        rows, b.FEATURES, "y", methods=candidate_methods(), control=control("DEV"), train=balanced,
    )


@query("oof_predictions")
def oof_predictions(spark, d):
    return _members(spark, d, FULL_LENGTH)[2]


@query("greedy_ensemble")
def greedy_ensemble(spark, d):
    return ensemble.greedy_ensemble(_members(spark, d)[2], "y", _SCORES)


def _built(spark, d):
    rows = prepared(spark, d)
    train = workflow.training_rows(rows, b.FEATURES, "y", control("DEV"), key="id")
    methods = candidate_methods()
    built = workflow.construct_models(train, b.FEATURES, "y", top=methods[:8], dissimilar=methods[-8:], folds=FOLDS, length=LENGTH)
    return rows, built


@query("construct_models")
def construct_models(spark, d):
    """Area under the curve of the four ensembles on the validation rows."""
    rows, built = _built(spark, d)
    return workflow.ensemble_areas(built.transform(rows.where("split = 'validdata'")), "y")


@query("raw_predictions")
def raw_predictions(spark, d):
    """All customers scored by the best of the four ensembles."""
    rows, built = _built(spark, d)
    return workflow.raw_predictions(built, rows, rows, b.FEATURES, "y", key="id")


@query("stacked_ensemble")
def stacked_ensemble(spark, d):
    """Area under the curve of both stackers and every base model on the validation rows."""
    rows, models, held = _members(spark, d)
    valid = ensemble.apply_models(rows.where("split = 'validdata'"), models)
    for method in ("rf", "gbm"):
        top = ensemble.stacked_ensemble(held, "y", _SCORES, method=method, fold="fold", folds=FOLDS, length=workflow.STACK_DEPTHS)
        valid = ensemble.apply_models(valid, {method: top})
    scores = F.array(*[F.struct(F.lit(s).alias("model"), C(s).alias("score")) for s in [*_SCORES, "p_rf", "p_gbm"]])
    return evaluate.roc_auc(valid.select("y", F.inline(scores)), "score", "y", by=["model"])


@query("score_cohort")
def score_cohort(spark, d):
    """Score all customers by a weighted ensemble with a threshold from the validation rows."""
    rows, models, held = _members(spark, d)
    weights = {r["model"]: r["weight"] for r in ensemble.greedy_ensemble(held, "y", _SCORES).collect()}
    cohort = features.align_columns(rows, b.FEATURES, keep=["id", "y"])
    scored = stage(ensemble.score_cohort(cohort, models, weights, threshold=0.0).drop("bestThresh"), "scored")
    valid = scored.join(rows.where("split = 'validdata'").select("id"), "id", "left_semi")
    best = evaluate.best_threshold(valid, "pred", "y").select("threshold").scalar()
    return scored.withColumn("bestThresh", best)


@query("model_dissimilarity", "WITH " + b.DOCS + " " + " UNION ALL ".join(
    f"""SELECT '{x}' AS model_a, '{y}' AS model_b,
  {b.r(f"coalesce(1 - count(*) FILTER (({x} >= 0.4) <> (y = 1) AND ({y} >= 0.4) <> (y = 1)) / nullif(count(*) FILTER (({x} >= 0.4) <> (y = 1) OR ({y} >= 0.4) <> (y = 1)), 0), 0)")} AS distance
FROM docs""" for i, x in enumerate(b.MODELS) for y in b.MODELS[i + 1:]
))
def model_dissimilarity(spark, d):
    return b.rounded(search.model_dissimilarity(b.doc_scores(spark, d), "y", b.MODELS, cut=0.4))


@query("model_impute")
def model_impute(spark, d):
    """Totals of customers with recent orders are treated as not final and estimated."""
    rows = search.with_folds(b.features(spark, d), "id", FOLDS)
    open_rows = rows.withColumn("total", F.when(C("recent") < 4, C("total")))
    filled = ensemble.model_impute(
        stage(open_rows, "open"), "total", ["acctbal", "n_orders", "urgent", "recent"], fold="fold", folds=FOLDS
    )
    return filled.select("id", "total", "total_filled")


@query("var_importance")
def var_importance(spark, d):
    rows = prepared(spark, d)
    model = ensemble.fit_models(rows.where("split = 'traindata'"), b.FEATURES, "y", ["rf"])["rf"]
    return ensemble.var_importance(rows.where("split = 'validdata'"), model, b.FEATURES, "y", key="id")


@query("bic_average")
def bic_average(spark, d):
    rows = features.poly_terms(prepared(spark, d), {"urgent": 2})
    groups = {"urgent": ["urgent", "urgent_2"], "orders": ["n_orders"], "balance": ["acctbal", "flagged"]}
    return averaging.bic_average(rows, "y", groups)


# Models that split the rows by nothing, one or two conditions; their fits are the shares of each cell.
_CELLS = [("none", 1, []), ("flagged", 2, ["flagged"]), ("urgent", 2, ["often"]), ("both", 4, ["flagged", "often"])]


@query("bic_weights_given", "WITH " + b.FEAT + ", r AS (SELECT y, flagged, CAST(urgent > 2 AS INT) AS often FROM feat), g AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS model, {k} AS k, count(*) AS n, sum(y) AS n1 FROM r {'GROUP BY ' + ', '.join(by) if by else ''}" for name, k, by in _CELLS) + f"""),
v AS (SELECT model, k, sum(n) AS n, -2 * sum(CASE WHEN n1 > 0 THEN n1 * ln(n1 / n) ELSE 0 END + CASE WHEN n1 < n THEN (n - n1) * ln((n - n1) / n) ELSE 0 END) AS deviance
  FROM g GROUP BY model, k),
e AS (SELECT model, exp(((SELECT min(deviance + ln(n) * k) FROM v) - deviance - ln(n) * k) / 2) AS w FROM v)
SELECT model, {b.r("w / (SELECT sum(w) FROM e)")} AS weight FROM e
""")
def bic_weights_given(spark, d):
    """Weights of models whose deviances have a closed form."""
    rows = b.features(spark, d).select("y", "flagged", (C("urgent") > 2).cast("int").alias("often"))
    parts = []
    for name, k, by in _CELLS:
        cells = rows.groupBy(*by).agg(F.count("*").alias("n"), F.sum("y").alias("n1"))
        some = lambda c: F.when(c > 0, c * F.log(c / C("n"))).otherwise(0.0)
        deviance = -2 * F.sum(some(C("n1")) + some(C("n") - C("n1")))
        parts.append(cells.agg(deviance.alias("deviance"), F.sum("n").alias("n")).select(F.lit(name).alias("model"), F.lit(k).alias("k"), "deviance", "n"))
    models = stage(parts[0].union(parts[1]).union(parts[2]).union(parts[3]), "deviances")
    return b.rounded(averaging.bic_weights(models, C("deviance"), C("k"), C("n")).select("model", "weight"))


# Scores and products of a logistic predictor with one column and given coefficients, in closed form.
_FIXED = b.FEAT + """,
q AS (SELECT urgent AS x, c_nationkey AS g, 1 / (1 + exp(-(CAST(-2.5 AS DOUBLE) + CAST(0.8 AS DOUBLE) * urgent))) AS m, y
      FROM feat JOIN customer ON id = c_custkey),
h AS (SELECT sum(m * (1 - m)) AS a, sum(m * (1 - m) * x) AS b, sum(m * (1 - m) * x * x) AS c, count(*) AS n FROM q),
u AS (SELECT g, sum(y - m) AS u0, sum((y - m) * x) AS u1 FROM q GROUP BY g),
k AS (SELECT sum(u0 * u0) AS p, sum(u0 * u1) AS q, sum(u1 * u1) AS r, count(*) AS k FROM u),
f AS (SELECT *, a * c - b * b AS det, (k / (k - 1)) * ((n - 1) / (n - 3)) AS corr FROM h, k),
v AS (SELECT corr / (det * det) * (c * (c * p - b * q) - b * (c * q - b * r)) AS v00,
             corr / (det * det) * (-b * (c * p - b * q) + a * (c * q - b * r)) AS v01,
             corr / (det * det) * (-b * (-b * p + a * q) + a * (-b * q + a * r)) AS v11 FROM f)
"""


@query("robust_vcov_given", "WITH " + _FIXED + f"""
SELECT '(Intercept)' AS row, '(Intercept)' AS col, {b.r("v00", 8)} AS value FROM v UNION ALL
SELECT '(Intercept)', 'urgent', {b.r("v01", 8)} FROM v UNION ALL
SELECT 'urgent', '(Intercept)', {b.r("v01", 8)} FROM v UNION ALL
SELECT 'urgent', 'urgent', {b.r("v11", 8)} FROM v
""")
def robust_vcov_given(spark, d):
    """The same for given coefficients, which has a closed form."""
    nation = load(spark, d, "customer").select(C("c_custkey").alias("id"), "c_nationkey")
    rows = stage(b.features(spark, d).join(nation, "id").select("urgent", "y", "c_nationkey"), "clustered")
    return b.rounded(robust.robust_vcov(
        rows, ["urgent"], "y", "c_nationkey", coefficients=[0.8], intercept=-2.5
    ), 8)


@query("robust_vcov")
def robust_vcov(spark, d):
    """Variance of a logistic fit, robust within segments of a nation."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    columns = ["urgent", "recent", "acctbal"]
    nation = load(spark, d, "customer").select(C("c_custkey").alias("id"), "c_nationkey")
    rows = stage(prepared(spark, d).join(nation, "id"), "clustered")
    assembled = VectorAssembler(inputCols=columns, outputCol="features").transform(rows)
    fit = LogisticRegression(labelCol="y", regParam=0.0).fit(assembled)
    return robust.robust_vcov(
        rows, columns, "y", "c_nationkey", coefficients=[float(x) for x in fit.coefficients], intercept=float(fit.intercept)
    )
