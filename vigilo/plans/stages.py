"""Pipeline stages that Spark ML does not have; their fitted forms are plain SQL."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Estimator, Transformer
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.operators.features import gram

SCORE = "p"


class PositiveScore(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Probability of class 1 as a plain column; margins pass through the logistic function."""

    source = Param(Params._dummy(), "source", "vector column", TypeConverters.toString)

    def __init__(self, source: str = "probability"):
        super().__init__()
        self._setDefault(source="probability")
        self._set(source=source)

    def _transform(self, df: DataFrame) -> DataFrame:
        source = self.getOrDefault(self.source)
        second = vector_to_array(F.col(source))[1]
        score = second if source == "probability" else F.lit(1.0) / (F.lit(1.0) + F.exp(-second))
        return df.withColumn(SCORE, score)


def _linear_sql(columns: Sequence[str], weights: Sequence[float], intercept: float) -> str:
    terms = [f"({float(w)!r}D) * `{c}`" for c, w in zip(columns, weights)]
    return " + ".join([f"({float(intercept)!r}D)", *terms])


def discriminant(n0: float, n1: float, m0: np.ndarray, m1: np.ndarray, pooled: np.ndarray, shrink: float = -1.0, ridge: float = 1e-6) -> tuple[np.ndarray, float]:
    """Weights and intercept from the class sizes, class means and pooled covariance."""
    if shrink >= 0:
        total = n0 + n1
        centre = (n0 * m0 + n1 * m1) / total
        var = np.maximum(np.diag(pooled), 1e-12)
        sd = np.sqrt(var) + np.median(np.sqrt(var))
        drawn = []
        for n, m in ((n0, m0), (n1, m1)):
            size = np.sqrt(1 / n - 1 / total)
            d = (m - centre) / (size * sd)
            d = np.sign(d) * np.maximum(np.abs(d) - shrink, 0)
            drawn.append(centre + size * sd * d)
        m0, m1 = drawn
        weights = (m1 - m0) / sd**2
    else:
        add = ridge * max(np.trace(pooled) / len(m0), 1e-12)
        weights = np.linalg.solve(pooled + add * np.eye(len(m0)), m1 - m0)
    return weights, float(-0.5 * (m0 + m1) @ weights + np.log(n1 / n0))


class LinearDiscriminant(Estimator):
    """Two-class discriminant from class means and the pooled covariance.

    With ``shrink`` the covariance is diagonal and the class means are drawn towards the overall
    mean, features with little difference dropping out.
    """

    shrink = Param(Params._dummy(), "shrink", "centroid shrinkage, negative for none", TypeConverters.toFloat)
    ridge = Param(Params._dummy(), "ridge", "share of the diagonal added", TypeConverters.toFloat)
    columns = Param(Params._dummy(), "columns", "features", TypeConverters.toListString)
    label = Param(Params._dummy(), "label", "label", TypeConverters.toString)

    def __init__(self, columns: Sequence[str], label: str, shrink: float = -1.0, ridge: float = 1e-6):
        super().__init__()
        self._set(columns=list(columns), label=label, shrink=shrink, ridge=ridge)

    def _fit(self, df: DataFrame) -> SQLTransformer:
        columns, label = self.getOrDefault(self.columns), self.getOrDefault(self.label)
        means = df.groupBy(F.col(label).cast("int").alias("y")).agg(
            F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]
        ).collect()
        by_class = {r["y"]: (r["n"], np.array([r[f"m{i}"] for i in range(len(columns))])) for r in means}
        (n0, m0), (n1, m1) = by_class[0], by_class[1]
        total = n0 + n1
        centre = (n0 * m0 + n1 * m1) / total
        scatter = gram(df, columns, centre=centre) - n0 * np.outer(m0 - centre, m0 - centre) - n1 * np.outer(m1 - centre, m1 - centre)
        pooled = scatter / max(1, total - 2)
        weights, intercept = discriminant(n0, n1, m0, m1, pooled, self.getOrDefault(self.shrink), self.getOrDefault(self.ridge))
        linear = _linear_sql(columns, weights, intercept)
        return SQLTransformer(statement=f"SELECT *, 1D / (1D + exp(-({linear}))) AS {SCORE} FROM __THIS__")


class HingeBasis(Estimator):
    """Piecewise linear terms on both sides of quantile knots of each column."""

    columns = Param(Params._dummy(), "columns", "features", TypeConverters.toListString)
    knots = Param(Params._dummy(), "knots", "knots per column", TypeConverters.toInt)

    def __init__(self, columns: Sequence[str], knots: int = 3):
        super().__init__()
        self._set(columns=list(columns), knots=knots)

    def _fit(self, df: DataFrame) -> SQLTransformer:
        columns, knots = self.getOrDefault(self.columns), self.getOrDefault(self.knots)
        probabilities = [(i + 1) / (knots + 1) for i in range(knots)]
        cuts = df.approxQuantile(columns, probabilities, 0.01)
        terms = []
        for c, at in zip(columns, cuts):
            for q in sorted(set(at)):
                terms += [f"greatest(`{c}` - ({q!r}D), 0D)", f"greatest(({q!r}D) - `{c}`, 0D)"]
        picked = ", ".join(f"{t} AS __h{i}" for i, t in enumerate(terms))
        return SQLTransformer(statement=f"SELECT *, {picked} FROM __THIS__")


class HingeAssembler(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Collect the hinge terms, however many knots were distinct, into the feature vector."""

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.feature import VectorAssembler

        terms = [c for c in df.columns if c.startswith("__h")]
        return VectorAssembler(inputCols=terms, outputCol="features").transform(df).drop(*terms)
