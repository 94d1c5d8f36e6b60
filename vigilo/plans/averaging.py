"""Bayesian model averaging over subsets of column groups: leaps and bounds on one fit, then exact refits of what is left."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.operators.groups import table_stats
from vigilo.plans import smooth
from vigilo.plans.batched import column_marks, moments, spread
from vigilo.plans.blocks import Block, pack, totals
from vigilo.plans.fitted import logistic

#: Subsets refitted in one sequence of jobs.
TOGETHER = 2048


def bic_weights(models: DataFrame, deviance: Column, parameters: Column, n: Column, *, window: float | None = None, name: str = "weight") -> DataFrame:
    """Posterior weight of each model, exp(-BIC/2) as a share of their sum.

    With ``window`` the models whose weight is under 1/``window`` of the best one's leave (Occam's window) and the others share
    the whole.
    """
    scored = models.withColumn("bic", deviance + F.log(n) * parameters)
    low = table_stats(scored, {"low": F.min("bic")})["low"]
    raw = scored.withColumn("__raw", F.exp((low - F.col("bic")) / 2))
    if window is not None:
        raw = raw.where(F.col("__raw") >= 1.0 / window)
    total = table_stats(raw, {"total": F.sum("__raw")})["total"]
    return raw.withColumn(name, F.col("__raw") / total).drop("__raw")


def leaps(products: np.ndarray, groups: Sequence[Sequence[int]], base: float, penalty: float, slack: float) -> tuple[list[tuple[int, ...]], int]:
    """Non-empty subsets of groups whose criterion is within ``slack`` of the best one, and how many sums were solved.

    ``products`` are weighted sums of products of (one, columns, response). The criterion of a subset is ``base``, what
    its residual sum exceeds that of all columns by, and ``penalty`` for each parameter. Leaving more out never lowers a
    residual sum, so a branch ends once what it has left out and the columns it must keep exceed the best by more than the slack.
    """
    solved = 0
    memory: dict[tuple[int, ...], float] = {}

    def residual(kept: tuple[int, ...]) -> float:
        nonlocal solved
        if kept not in memory:
            solved += 1
            at = [0, *[1 + c for g in kept for c in groups[g]]]
            inner, right = products[np.ix_(at, at)], products[at, -1]
            scale = np.sqrt(np.maximum(np.diag(inner), 1e-300))
            solution = np.linalg.lstsq(inner / np.outer(scale, scale), right / scale, rcond=1e-12)[0]
            memory[kept] = float(products[-1, -1] - solution @ (right / scale))
        return memory[kept]

    every = tuple(range(len(groups)))
    whole = residual(every)
    loss = lambda kept: residual(tuple(sorted(kept))) - whole
    size = [len(g) for g in groups]
    # The groups that cost most to leave out are decided first: bounds then bite early.
    order = sorted(every, key=lambda g: -loss([k for k in every if k != g]))
    best = base + penalty * (1 + sum(size))
    greedy = list(every)
    for g in reversed(order):
        rest = [k for k in greedy if k != g]
        if rest:
            value = base + loss(rest) + penalty * (1 + sum(size[k] for k in rest))
            if value < best:
                best, greedy = value, rest
    found: list[tuple[float, tuple[int, ...]]] = []
    stack = [(0, (), 0)]
    while stack:
        at, out, parameters = stack.pop()
        bound = base + loss([g for g in every if g not in out]) + penalty * (1 + parameters)
        if bound > best + slack:
            continue
        if at == len(order):
            kept = tuple(g for g in every if g not in out)
            if kept:
                best = min(best, bound)
                found.append((bound, kept))
            continue
        g = order[at]
        stack.append((at + 1, (*out, g), parameters))
        stack.append((at + 1, out, parameters + size[g]))
    return [kept for value, kept in sorted(found) if value <= best + slack], solved


def bic_average(
    df: DataFrame, label: str, groups: Mapping[str, Sequence[str]], *, window: float | None = None
) -> DataFrame:
    """Bayesian model averaging of logistic fits over subsets of column groups.

    All non-empty subsets by default. With ``window`` (Occam's window, as 20) one fit of all columns gives weighted sums of
    products; from these, branch and bound finds the subsets whose approximate criterion may lie in the window (twice as wide, for
    the approximation), and only they are fitted. Subsets are fitted side by side, some thousand in one sequence of jobs.

    Weights are proportional to exp(-BIC/2). One row per group: probability of inclusion; one row
    per column: averaged coefficient. ``(term, kind, value)``. Without usable rows of both labels the result is empty.
    """
    spark = df.sparkSession
    schema = "term string, kind string, value double"
    names = list(groups)
    columns = [c for g in groups.values() for c in g]
    at, place = [], 0
    for g in groups.values():
        at.append(list(range(place, place + len(g))))
        place += len(g)
    blocks = pack(df, columns, label, [], None)
    marks = column_marks(df, columns, label, None)
    if not marks:
        return spark.createDataFrame([], schema)
    centre = {g: q[:, q.shape[1] // 2] for g, q in marks.items()}
    sums = moments(blocks, {}, centre, 0, {})
    if "|n0" not in sums or not sums["|n0"][0] or not sums["|n1"][0]:
        return spark.createDataFrame([], schema)
    n = float(sums["|n0"][0] + sums["|n1"][0])
    total, square = sums["|s0"][0] + sums["|s1"][0], np.diag(sums["|q0"][0] + sums["|q1"][0])
    mean, sd = spread(n, total, square)
    mean = mean + centre[""]

    def fit(subset: Sequence[int] | None) -> smooth.Fit:
        if subset is None:
            return smooth.Fit(0, {}, n, mean, sd)
        used = [c for g in subset for c in at[g]]
        return smooth.Fit(0, {}, n, mean[used], sd[used], project=np.eye(len(columns))[:, used])

    if window is None:
        subsets = [tuple(g for g in range(len(names)) if mask >> g & 1) for mask in range(1, 1 << len(names))]
    else:
        full = fit(None)
        smooth.solve(blocks, {("", "full"): (smooth.Basis("raw"), [full])}, 0, {})
        theta = full.raw(full.theta)

        def products(block: Block) -> dict[str, np.ndarray]:
            if block.lane:
                return {}
            # Columns are centred, which changes no subset's fit as all have an intercept.
            eta = theta[0] + block.x @ theta[1:]
            p = logistic(eta)
            weight = np.maximum(p * (1 - p), 1e-10)
            rows = np.column_stack([np.ones(len(eta)), block.x - mean, eta + (block.y - p) / weight])
            return {"s": rows.T @ (rows * weight[:, None])}

        deviance = 2 * full.value * n
        subsets, _ = leaps(totals(blocks, products)["s"], at, deviance, math.log(n), 2 * 2 * math.log(window))
    fits = []
    for first in range(0, len(subsets), TOGETHER):
        part = [fit(s) for s in subsets[first:first + TOGETHER]]
        smooth.solve(blocks, {("", "subsets"): (smooth.Basis("raw"), part)}, 0, {})
        fits += part
    blocks.release()
    bics = np.array([2 * f.value * n + math.log(n) * len(f.theta) for f in fits])
    raw = np.exp(-(bics - bics.min()) / 2)
    if window is not None:
        raw = np.where(raw >= 1 / window, raw, 0.0)
    weights = raw / raw.sum()
    coefficients = np.zeros((len(fits), len(columns) + 1))
    for k, (f, s) in enumerate(zip(fits, subsets, strict=True)):
        coefficients[k, [0, *[1 + c for g in s for c in at[g]]]] = f.raw(f.theta)
    averaged = weights @ coefficients
    out = [(g, "inclusion", float(sum(w for w, s in zip(weights, subsets, strict=True) if k in s))) for k, g in enumerate(names)]
    out += [(c, "coefficient", float(v)) for c, v in zip(columns, averaged[1:], strict=True)]
    out.append(("(Intercept)", "coefficient", float(averaged[0])))
    return spark.createDataFrame(out, schema)
