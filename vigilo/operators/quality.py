"""Expectations on an export, compiled to one aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.operators.ordering import quantiles


@dataclass(frozen=True)
class Check:
    """A named measure with inclusive bounds, or strict ones; no bound means unlimited."""

    name: str
    value: Column | None
    lower: float | None = None
    upper: float | None = None
    strict: bool = False
    median_of: str | None = None


def rows(lower: float | None = None, upper: float | None = None, where: Column | None = None, name: str = "rows", strict: bool = True) -> Check:
    counted = F.count(F.lit(1)) if where is None else F.count_if(where)
    return Check(name, counted, lower, upper, strict)


def category(column: str, label: str, lower: float | None = None, upper: float | None = None) -> Check:
    return Check(f"{column}={label}", F.count_if(F.col(column) == label), lower, upper, True)


def categories(column: str, expected: int) -> Check:
    return Check(f"categories({column})", F.count_distinct(F.col(column)), expected, expected)


def nulls(column: str, upper: float, strict: bool = True) -> Check:
    return Check(f"nulls({column})", F.count_if(F.col(column).isNull()), None, upper, strict)


def statistic(kind: str, column: str, lower: float | None = None, upper: float | None = None, strict: bool = False) -> Check:
    """``kind`` is min, max, avg or median; equal bounds ask for an exact value."""
    name = f"{kind}({column})"
    if kind == "median":
        return Check(name, None, lower, upper, strict, median_of=column)
    return Check(name, getattr(F, kind)(column), lower, upper, strict)


def mean_above(column: str, other: str) -> Check:
    return Check(f"avg({column})>avg({other})", F.avg(column) - F.avg(other), 0.0, None, True)


def columns_match(df: DataFrame, expected: Sequence[str]) -> Check:
    """1 if the frame has exactly these columns in this order."""
    return Check("columns", F.max(F.lit(int(df.columns == list(expected)))), 1, 1)


def quality_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: ``(check, value, lower, upper, passed)``.

    All plain measures share one pass. Medians are exact and come from value counts.
    """
    plain = df.agg(
        *[c.value.cast("double").alias(f"v{i}") for i, c in enumerate(checks) if c.median_of is None],
        F.count(F.lit(1)).alias("__all"),
    )
    middle = {i: c.median_of for i, c in enumerate(checks) if c.median_of is not None}
    if middle:
        values = [
            F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("value")) for i, c in middle.items()
        ]
        medians = quantiles(df.select(F.inline(F.array(*values))), "value", [0.5], by=["i"])
        found = {r["i"]: r["q0"] for r in medians.collect()}
        plain = plain.withColumns({f"v{i}": F.lit(found.get(i)).cast("double") for i in middle})
    out = []
    for i, c in enumerate(checks):
        value = F.col(f"v{i}")
        ok = F.lit(True)
        if c.lower is not None:
            ok = ok & (value > c.lower if c.strict else value >= c.lower)
        if c.upper is not None:
            ok = ok & (value < c.upper if c.strict else value <= c.upper)
        out.append(
            F.struct(
                F.lit(c.name).alias("check"),
                value.alias("value"),
                F.lit(c.lower).cast("double").alias("lower"),
                F.lit(c.upper).cast("double").alias("upper"),
                F.coalesce(ok, F.lit(False)).alias("passed"),
            )
        )
    return plain.select(F.inline(F.array(*out)))
