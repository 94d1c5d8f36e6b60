"""Ranking of search results by score, speed and time budget."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def topk_distinct(results: DataFrame, score: str, method: str, *, k: int = 5) -> DataFrame:
    """The ``k`` best and the ``k`` worst distinct scores and the methods that hold them.

    Distinct scores are reduced first; only ``k`` of them are sorted out at either end.
    """
    distinct = results.where(F.col(score).isNotNull()).select(F.col(score).alias("__s")).distinct()
    top = distinct.orderBy(F.desc("__s")).limit(k).withColumn("end", F.lit("top"))
    bottom = distinct.orderBy("__s").limit(k).withColumn("end", F.lit("bottom"))
    picked = top.unionByName(bottom)
    return (
        results.join(picked, F.col(score) == F.col("__s"))
        .select("end", method, score)
        .distinct()
    )


def efficiency(score: Column, elapsed: Column) -> Column:
    """Score per square root of time."""
    return F.try_divide(score, F.sqrt(elapsed)) * 1000


def error_efficiency(error: Column, elapsed: Column) -> Column:
    """Efficiency of a regression method: large for quick methods with a small error."""
    return F.bround(F.try_divide(F.lit(10.0), elapsed + error * error), 2)


def efficiency_topn(
    results: DataFrame, method: str, *, efficiency_col: Column, n: int = 8, ties: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` distinct result rows with the best efficiency.

    Equal ones are ordered by method, then by the columns ``ties``.
    """
    rows = results.distinct().withColumn("efficiency", efficiency_col)
    return rows.orderBy(F.desc_nulls_last("efficiency"), method, *ties).limit(n)


def budget_topn(
    results: DataFrame, method: str, *, elapsed: str, efficiency_col: Column, grade: int, n: int = 8
) -> DataFrame:
    """As :func:`efficiency_topn` among the methods that stay within the grade's time budget."""
    within = results.where(F.col(elapsed) < time_budget(grade))
    return efficiency_topn(within, method, efficiency_col=efficiency_col, n=n)


def time_budget(grade: int) -> float:
    return grade * 100 * 0.85


def search_summary(results: DataFrame, method: str, score: str) -> DataFrame:
    """Which methods succeeded: best score, or none if every run failed."""
    return results.groupBy(method).agg(
        F.max(score).alias(score), F.bool_or(F.col(score).isNotNull()).alias("succeeded")
    )
