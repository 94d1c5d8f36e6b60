"""Cluster-robust variance of a fitted linear predictor and the variance of its predictions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.operators.features import gram


def _linear(columns: Sequence[str], coefficients: Sequence[float], intercept: float):
    out = F.lit(float(intercept))
    for c, b in zip(columns, coefficients):
        out = out + F.col(c) * F.lit(float(b))
    return out


def robust_vcov(
    df: DataFrame, columns: Sequence[str], label: str, cluster: str, *,
    coefficients: Sequence[float], intercept: float, family: str = "binomial",
) -> DataFrame:
    """Variance matrix ``(row, col, value)`` of a fitted model, robust within clusters.

    The rows are used twice: for the weighted products of columns and for the score sums of each
    cluster, which are combined before the shuffle. Both end in one number per pair of columns;
    only the final inversion happens on the driver. ``family`` is ``binomial`` (logit) or
    ``gaussian``. With fewer than two clusters, or no more rows than parameters, all values are missing.
    """
    columns = list(columns)
    names = ["(Intercept)", *columns]
    used = df.dropna("any", subset=[*columns, label])
    eta = _linear(columns, coefficients, intercept)
    if family == "binomial":
        mean = F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))
        weight, dispersion = mean * (F.lit(1.0) - mean), None
    elif family == "gaussian":
        mean, weight = eta, F.lit(1.0)
        dispersion = used.agg(F.avg((F.col(label) - mean) * (F.col(label) - mean)).alias("d")).first()["d"]
    else:
        raise ValueError(f"unknown family {family}")
    residual = F.col(label) - mean
    rows = used.withColumns({"__w": weight, "__r": residual})

    scale = 1.0 if dispersion is None else dispersion
    scores = rows.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("__n"),
        (F.sum("__r") / scale).alias("__u0"),
        *[(F.sum(F.col("__r") * F.col(c)) / scale).alias(f"__u{i + 1}") for i, c in enumerate(columns)],
    )
    sizes = scores.agg(F.count(F.lit(1)).alias("m"), F.sum("__n").alias("n")).first()
    m, n, k = sizes["m"], sizes["n"], len(names)
    if m < 2 or n <= k + 1:
        return df.sparkSession.createDataFrame([(a, b, None) for a in names for b in names], "row string, col string, value double")
    bread = np.linalg.inv(gram(rows, columns, weight="__w", intercept=True))
    correction = (m / (m - 1)) * ((n - 1) / (n - k - 1))
    meat = gram(scores, [f"__u{i}" for i in range(k)])
    unscaled = bread * scale
    vcov = correction * (unscaled @ meat @ unscaled)
    entries = [(names[i], names[j], float(vcov[i, j])) for i in range(k) for j in range(k)]
    return df.sparkSession.createDataFrame(entries, "row string, col string, value double")


def prediction_variance(
    df: DataFrame, columns: Sequence[str], vcov: Sequence[Sequence[float]], *,
    coefficients: Sequence[float], intercept: float,
) -> DataFrame:
    """Linear prediction ``fit`` and its variance ``se_fit`` per row.

    The matrix is small, so the quadratic form is spelled out as a column expression.
    """
    x = [F.lit(1.0), *[F.col(c) for c in columns]]
    total = F.lit(0.0)
    for i, a in enumerate(x):
        for j, b in enumerate(x):
            total = total + a * F.lit(float(vcov[i][j])) * b
    return df.withColumns({"fit": _linear(columns, coefficients, intercept), "se_fit": total})
