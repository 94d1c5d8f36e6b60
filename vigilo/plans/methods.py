"""The classifiers and regressors a search can try, each as a Spark ML pipeline."""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder

from vigilo.plans.stages import SCORE, HingeAssembler, HingeBasis, LinearDiscriminant, PositiveScore

SEED = 7


@dataclass(frozen=True)
class Candidate:
    """A pipeline from flat columns to the score column, and the settings to tune over."""

    pipeline: Pipeline
    grid: list[dict]


def _assembler(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features")


def spread_values(low: float, high: float, length: int) -> list[float]:
    """``length`` values between two limits on a log scale."""
    if length <= 1:
        return [low]
    return [low * (high / low) ** (i / (length - 1)) for i in range(length)]


def _candidate(columns, estimator, param, values, *, before=(), source="probability") -> Candidate:
    stages = [*(before or [_assembler(columns)]), estimator, PositiveScore(source)]
    grid = ParamGridBuilder()
    if param is not None and len(values) > 1:
        grid = grid.addGrid(param, list(dict.fromkeys(values)))
    elif param is not None and values:
        estimator.set(param, values[0])
    return Candidate(Pipeline(stages=stages), grid.build())


def _forest(columns, label, length):
    e = C.RandomForestClassifier(labelCol=label, numTrees=20, maxDepth=6, seed=SEED)
    return _candidate(columns, e, e.maxDepth, list(range(6, 6 + length)))


def _bagged(columns, label, length):
    e = C.RandomForestClassifier(labelCol=label, numTrees=15, featureSubsetStrategy="all", seed=SEED)
    return _candidate(columns, e, e.maxDepth, list(range(5, 5 + length)))


def _tree(columns, label, length):
    e = C.DecisionTreeClassifier(labelCol=label, seed=SEED)
    return _candidate(columns, e, e.maxDepth, list(range(3, 3 + length)))


def _boosted(columns, label, length):
    e = C.GBTClassifier(labelCol=label, maxIter=10, seed=SEED)
    return _candidate(columns, e, e.maxDepth, list(range(2, 2 + length)))


def _logistic(columns, label, length):
    e = C.LogisticRegression(labelCol=label, regParam=0.0, maxIter=25)
    return _candidate(columns, e, None, [])


def _elastic(columns, label, length):
    e = C.LogisticRegression(labelCol=label, elasticNetParam=0.5, maxIter=25)
    return _candidate(columns, e, e.regParam, spread_values(0.001, 0.1, length))


def _ridge(columns, label, length):
    e = C.LogisticRegression(labelCol=label, elasticNetParam=0.0, maxIter=25)
    return _candidate(columns, e, e.regParam, spread_values(0.001, 0.1, length))


def _svm(columns, label, length):
    e = C.LinearSVC(labelCol=label, maxIter=20)
    return _candidate(columns, e, e.regParam, spread_values(0.001, 0.1, length), source="rawPrediction")


def _bayes(columns, label, length):
    e = C.NaiveBayes(labelCol=label, modelType="gaussian")
    return _candidate(columns, e, None, [])


def _components(columns, length):
    return max(2, min(len(columns), 2 + length))


def _net(columns, label, length):
    k = _components(columns, length)
    before = [VectorAssembler(inputCols=list(columns), outputCol="raw"), PCA(k=k, inputCol="raw", outputCol="features")]
    e = C.MultilayerPerceptronClassifier(labelCol=label, layers=[k, 4, 2], maxIter=30, seed=SEED)
    return _candidate(columns, e, None, [], before=before)


def _partial(columns, label, length):
    k = _components(columns, length)
    before = [VectorAssembler(inputCols=list(columns), outputCol="raw"), PCA(k=k, inputCol="raw", outputCol="features")]
    e = C.LogisticRegression(labelCol=label, maxIter=25)
    return _candidate(columns, e, None, [], before=before)


def _hinge(columns, label, length):
    e = C.LogisticRegression(labelCol=label, regParam=0.01, elasticNetParam=0.5, maxIter=25)
    before = [HingeBasis(columns, knots=3), HingeAssembler()]
    return _candidate(columns, e, e.regParam, spread_values(0.001, 0.1, length), before=before)


def _discriminant(columns, label, length):
    e = LinearDiscriminant(columns, label)
    return Candidate(Pipeline(stages=[e]), [{}])


def _centroid(columns, label, length):
    e = LinearDiscriminant(columns, label, shrink=0.5)
    grid = ParamGridBuilder()
    if length > 1:
        grid = grid.addGrid(e.shrink, [0.5 * i for i in range(length)])
    return Candidate(Pipeline(stages=[e]), grid.build())


CLASSIFIERS: dict[str, Callable] = {
    "random_forest": _forest,
    "bagged_trees": _bagged,
    "decision_tree": _tree,
    "boosted_trees": _boosted,
    "logistic": _logistic,
    "elastic_net": _elastic,
    "ridge_logistic": _ridge,
    "linear_svm": _svm,
    "naive_bayes": _bayes,
    "component_net": _net,
    "component_logistic": _partial,
    "hinge_logistic": _hinge,
    "linear_discriminant": _discriminant,
    "shrunken_centroid": _centroid,
}

#: All methods; the radial machine has no pipeline of its own, only the batched fit.
METHODS = [*CLASSIFIERS, "radial_svm"]

# The method names of a search request and the pipeline that does their work.
ALIASES = {
    "rf": "random_forest", "ORFlog": "random_forest", "ORFpls": "random_forest",
    "treebag": "bagged_trees",
    "rpart": "decision_tree", "C5.0Rules": "decision_tree",
    "gbm": "boosted_trees",
    "glm": "logistic",
    "glmnet": "elastic_net", "plr": "ridge_logistic",
    "svmLinear": "linear_svm", "svmRadialCost": "radial_svm",
    "nb": "naive_bayes",
    "pcaNNet": "component_net",
    "pls": "component_logistic", "kernelpls": "component_logistic", "spls": "component_logistic",
    "earth": "hinge_logistic", "gcvEarth": "hinge_logistic",
    "slda": "linear_discriminant", "mda": "linear_discriminant", "hdda": "linear_discriminant",
    "pda": "linear_discriminant", "stepLDA": "linear_discriminant",
    "pam": "shrunken_centroid",
}


def candidate_methods(n: int | None = None, *, full: bool = False, seed: int = 0) -> list[str]:
    """The methods that stand for the usual candidate list, or all of them; ``n`` samples."""
    names = list(METHODS) if full else [m for m in METHODS if m in set(ALIASES.values()) - {"boosted_trees"}]
    return names if n is None else random.Random(seed).sample(names, n)


def classifier(method: str, columns: Sequence[str], label: str, length: int = 1) -> Candidate:
    return CLASSIFIERS[ALIASES.get(method, method)](list(columns), label, length)


def regressors(columns: Sequence[str], label: str) -> dict[str, Pipeline]:
    """Regression pipelines for imputation; all write the score column."""
    common = {"labelCol": label, "predictionCol": SCORE}
    models = {
        "linear": R.LinearRegression(maxIter=25, regParam=0.0, **common),
        "elastic_linear": R.LinearRegression(maxIter=25, regParam=0.05, elasticNetParam=0.5, **common),
        "tree": R.DecisionTreeRegressor(maxDepth=5, seed=SEED, **common),
        "forest": R.RandomForestRegressor(numTrees=15, maxDepth=5, seed=SEED, **common),
    }
    return {name: Pipeline(stages=[_assembler(columns), m]) for name, m in models.items()}
