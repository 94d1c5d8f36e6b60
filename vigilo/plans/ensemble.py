"""Held-out predictions, weighted and stacked ensembles, scoring, imputation, importance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.functions.hashing import digest
from vigilo.operators.evaluate import roc_auc
from vigilo.operators.features import gram
from vigilo.operators.groups import table_stats
from vigilo.operators.ordering import hash_ranks
from vigilo.plans.batched import Fits, fit_all, known_method
from vigilo.plans.blocks import Block, pack, totals
from vigilo.plans.concurrent import together
from vigilo.plans.fitted import SCORE, Fitted, with_scores
from vigilo.plans.methods import regressors
from vigilo.plans.search import with_folds
from vigilo.sources.tables import stage

_SCRATCH = ("raw", "features", "rawPrediction", "probability", "prediction")


def apply_models(df: DataFrame, models: Mapping[str, Fitted | PipelineModel]) -> DataFrame:
    """Add the score of each model as ``p_<name>``; one narrow pass, no join."""
    out = with_scores(df, {f"p_{n}": m for n, m in models.items() if isinstance(m, Fitted)})
    for name, model in models.items():
        if not isinstance(model, Fitted):
            out = model.transform(out).withColumnRenamed(SCORE, f"p_{name}").drop(*_SCRATCH)
    return out


def tune_members(
    df: DataFrame, columns: Sequence[str], label: str, methods: Sequence[str], *, fold: str, folds: int, length: int = 1, group: str | None = None, metric: str = "ROC",
) -> Fits:
    """All methods fitted for every fold and on all rows, each at the best of ``length`` settings over those folds."""
    fits = fit_all(df, columns, label, methods, folds=[fold], count=folds, length=length, group=group)
    if length > 1:
        fits.tune(df, metric)
    return fits


def fit_models(
    df: DataFrame, columns: Sequence[str], label: str, methods: Sequence[str], *, length: int = 1, folds: int = 10
) -> dict[str, Fitted]:
    """One model per method. With a ``length`` above 1 each is tuned over its settings by ``folds`` folds first."""
    if length > 1:
        fits = tune_members(stage(with_folds(df, columns, folds, seed="tune", name="__tune"), "folds"), columns, label, methods, fold="__tune", folds=folds, length=length)
    else:
        fits = fit_all(df, columns, label, methods, folds=[], count=0)
    found = fits.final()
    return {m: found[known_method(m)] for m in methods}


def oof_predictions(
    df: DataFrame, columns: Sequence[str], label: str, methods: Sequence[str], *, key: str | None, fold: str, folds: int, length: int = 1,
) -> DataFrame:
    """Score of every row by models that never saw its fold: ``(key, fold, label, p_...)``.

    Synthetic rows have no key; pass ``key=None`` for them. With a ``length`` above 1 each method gets its best
    setting over the same folds first.
    """
    return held_scores(tune_members(df, columns, label, methods, fold=fold, folds=folds, length=length), df, methods, key=key, fold=fold)


def held_scores(fits: Fits, df: DataFrame, methods: Sequence[str], *, key: str | None, fold: str) -> DataFrame:
    """Held-out scores of fitted members as ``(key, fold, label, p_...)``, with the group if there is one."""
    held = fits.held_out(df, keep=[*([key] if key else []), fold])
    group = [fits.group] if fits.group else []
    return held.select(*([key] if key else []), fold, *group, fits.label, *[F.col(f"p_{known_method(m)}").alias(f"p_{m}") for m in methods])


#: Steps of a score when areas are measured for the choice of weights: scores are rounded to one part in so many.
AREA_STEPS = 1 << 14


def greedy_ensemble(
    oof: DataFrame, label: str, scores: Sequence[str], *, rounds: int = 20, group: str | None = None, allowed: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Weights ``(model, weight, auc)`` by repeatedly adding the model that helps most.

    A model may be added again. Each round is one job that counts, for every candidate of every group, rows of either
    label per rounded score; the areas come from those counts, ties counting half. A group stops when nothing improves.
    ``auc`` is that of the final ensemble. With ``group`` the column of that name says whose weights they are, and
    ``allowed`` may name the scores a group can use.
    """
    scores = list(scores)
    blocks = pack(oof, scores, label, [], group)
    names = sorted({r["g"] for r in blocks.table.select("g").distinct().collect()})
    usable = {g: [scores.index(s) for s in (allowed[g] if allowed is not None else scores)] for g in names}
    taken: dict[str, list[int]] = {g: [] for g in names}
    best = dict.fromkeys(names, -1.0)
    open_ = {g for g in names if usable[g]}
    for _ in range(rounds):
        if not open_:
            break
        plan = {g: (usable[g], list(taken[g])) for g in open_}

        def count(block: Block, plan=plan) -> dict[str, np.ndarray]:
            if block.group not in plan or block.lane:
                return {}
            tried, before = plan[block.group]
            base = block.x[:, before].sum(axis=1)
            out = np.zeros((len(tried), 2, AREA_STEPS + 1))
            for k, j in enumerate(tried):
                at = np.rint(np.clip((base + block.x[:, j]) / (len(before) + 1), 0, 1) * AREA_STEPS).astype(np.int64)
                for c in (0, 1):
                    out[k, c] = np.bincount(at[block.y == c], minlength=AREA_STEPS + 1)
            return {block.group: out}

        def area(name: str, start: int, counts: np.ndarray) -> np.ndarray:
            neg, pos = counts[:, 0], counts[:, 1]
            pairs = neg.sum(axis=1) * pos.sum(axis=1)
            won = (pos * (neg.cumsum(axis=1) - neg / 2)).sum(axis=1)
            return np.where(pairs > 0, won / np.maximum(pairs, 1), -1.0)

        found = totals(blocks, count, size=2 * (AREA_STEPS + 1) * sum(len(tried) for tried, _ in plan.values()), finish=area)
        for g in sorted(open_):
            areas = found[g]
            pick = int(areas.argmax())
            if areas[pick] <= best[g]:
                open_ = open_ - {g}
            else:
                best[g] = float(areas[pick])
                taken[g].append(usable[g][pick])
    blocks.release()
    weights = [(g, scores[j], taken[g].count(j) / max(1, len(taken[g])), best[g]) for g in names for j in usable[g]]
    out = oof.sparkSession.createDataFrame(weights, f"{group or 'g'} string, model string, weight double, auc double")
    return out if group is not None else out.drop("g")


def stacked_ensemble(
    oof: DataFrame, label: str, scores: Sequence[str], *, method: str = "rf", fold: str | None = None, folds: int = 5, length: int = 1
) -> Fitted:
    """A forest (``rf``) or boosted trees (``gbm``) over the held-out scores, tuned over ``length`` depths by the folds."""
    if method not in ("rf", "gbm"):
        raise ValueError(f"unknown stacker {method}")
    name = known_method(method)
    rows = oof if fold or length == 1 else stage(with_folds(oof, list(scores), folds, seed="stack", name="__stack"), "folds")
    fits = fit_all(rows, list(scores), label, [name], folds=[] if length == 1 else [fold or "__stack"], count=0 if length == 1 else folds, length=length)
    if length > 1:
        fits.tune(rows)
    found = fits.final()
    return found[name] if found else Fitted(name, "constant", list(scores), {}, {"value": np.array(0.5)})


def weighted_score(weights: Mapping[str, float]) -> tuple[Column, Column]:
    """Weighted mean of the model scores and their weighted standard deviation."""
    total = sum(weights.values())
    mean = sum((F.col(s) * (w / total) for s, w in weights.items()), F.lit(0.0))
    var = sum((F.pow(F.col(s) - mean, F.lit(2.0)) * (w / total) for s, w in weights.items()), F.lit(0.0))
    return mean, F.sqrt(var)


def score_cohort(
    df: DataFrame, models: Mapping[str, Fitted | PipelineModel], weights: Mapping[str, float], *, threshold: float
) -> DataFrame:
    """Score a cohort that has the training columns: ``pred``, ``se`` and ``bestThresh`` per row."""
    used = {m: models[m] for m in models if weights.get(f"p_{m}", 0) > 0}
    mean, spread = weighted_score({f"p_{m}": weights[f"p_{m}"] for m in used})
    scored = apply_models(df, used)
    return scored.select(*df.columns, mean.alias("pred"), spread.alias("se"), F.lit(threshold).alias("bestThresh"))


def greedy_error_weights(products: np.ndarray, *, rounds: int = 20) -> np.ndarray:
    """Greedy weights by squared error from the products of (estimates..., truth)."""
    k = len(products) - 1
    counts = np.zeros(k)
    best = np.inf

    def error(w: np.ndarray) -> float:
        full = np.append(w, -1.0)
        return float(full @ products @ full)

    for _ in range(rounds):
        trials = [error((counts + np.eye(k)[j]) / (counts.sum() + 1)) for j in range(k)]
        pick = int(np.argmin(trials))
        if trials[pick] >= best:
            break
        best = trials[pick]
        counts[pick] += 1
    return counts / max(1.0, counts.sum())


def model_impute(
    df: DataFrame, target: str, columns: Sequence[str], *, fold: str, folds: int, name: str | None = None
) -> DataFrame:
    """Estimate missing values of ``target`` by an ensemble fitted on the complete rows.

    Weights come from held-out predictions: their sums of products, one number per pair of
    models, decide every round. Observed values are kept; ``name`` holds the filled column.
    """
    name = name or f"{target}_filled"
    usable = df.dropna("any", subset=[target, *columns])
    kinds = regressors(columns, target)
    def one(f: int) -> DataFrame:
        models = {m: p.fit(usable.where(F.col(fold) != f)) for m, p in kinds.items()}
        return apply_models(usable.where(F.col(fold) == f), models).select(*[f"p_{m}" for m in kinds], target)

    parts = together(df.sparkSession, [partial(one, f) for f in range(folds)])
    oof = parts[0]
    for part in parts[1:]:
        oof = oof.unionByName(part)
    weights = greedy_error_weights(gram(oof, [*[f"p_{m}" for m in kinds], target]))
    chosen = {m: w for m, w in zip(kinds, weights) if w > 0}
    models = {m: kinds[m].fit(usable) for m in chosen}
    # Incomplete rows cannot be assembled into features and keep their missing value.
    ready = df.dropna("any", subset=list(columns))
    rest = df.where(~_complete(columns))
    estimate = sum((F.col(f"p_{m}") * w for m, w in chosen.items()), F.lit(0.0))
    filled = apply_models(ready, models).select(*df.columns, F.coalesce(F.col(target).cast("double"), estimate).alias(name))
    return filled.unionByName(rest.withColumn(name, F.col(target).cast("double")))


def _complete(columns: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def var_importance(
    df: DataFrame, model: Fitted | PipelineModel, columns: Sequence[str], label: str, *, key: str
) -> DataFrame:
    """Loss of area under the curve when one column is taken from another row.

    Rows are put in hash order and each gets the next one as donor, which serves all columns with
    one join. ``(column, drop, auc)``.
    """
    columns = list(columns)
    picked = df.select(key, label, *columns)
    ranked = hash_ranks(picked, digest(F.col(key), "donor"), "__rank", tie=key)
    n = F.lit(picked.count())
    donors = ranked.select(
        (F.pmod(F.col("__rank"), n) + 1).alias("__rank"), *[F.col(c).alias(f"__d_{c}") for c in columns]
    )
    both = ranked.join(donors, "__rank")
    base = model.transform(picked).select(F.lit("").alias("column"), label, SCORE)
    tried = base
    for c in columns:
        swapped = both.select(key, label, *[(F.col(f"__d_{x}") if x == c else F.col(x)).alias(x) for x in columns])
        tried = tried.unionByName(model.transform(swapped).select(F.lit(c).alias("column"), label, SCORE))
    areas = roc_auc(tried, SCORE, label, by=["column"])
    reference = table_stats(areas, {"whole": F.max(F.when(F.col("column") == "", F.col("auc")))})["whole"]
    return areas.where("column <> ''").select("column", (reference - F.col("auc")).alias("drop"), "auc")


def tree_importance(model: Fitted | PipelineModel, columns: Sequence[str]) -> DataFrame:
    """Impurity importance of a fitted tree model, in percent."""
    from pyspark.sql import SparkSession

    if isinstance(model, Fitted):
        shares = dict(zip(model.columns, model.feature_gain, strict=True))
        rows = [(c, float(shares.get(c, 0.0)) * 100) for c in columns]
    else:
        found = next(s for s in model.stages if hasattr(s, "featureImportances"))
        rows = [(c, float(v) * 100) for c, v in zip(columns, found.featureImportances.toArray())]
    return SparkSession.active().createDataFrame(rows, "column string, weight double")
