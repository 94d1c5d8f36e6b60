"""Searching over methods and telling apart those that err on different rows."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.functions.hashing import unit_hash
from vigilo.operators.evaluate import roc_auc
from vigilo.plans.batched import fit_all, known_method
from vigilo.plans.blocks import group_column
from vigilo.plans.control import Control
from vigilo.plans.fitted import long_scores
from vigilo.sources.tables import stage

RESULT_SCHEMA = "method string, grp string, auc double, elapsedTime double, status string"


def with_folds(
    df: DataFrame, key: str | Sequence[str], folds: int, *, seed: int | str = "fold", name: str = "fold"
) -> DataFrame:
    """Cross-validation fold of each row by a hash of its key, or of its features if it has none."""
    parts = [F.col(c) for c in ([key] if isinstance(key, str) else key)]
    return df.withColumn(name, F.floor(unit_hash(*parts, str(seed)) * folds).cast("int"))


def with_repeated_folds(df: DataFrame, key: str | Sequence[str], folds: int, reps: int) -> tuple[DataFrame, list[str]]:
    """A fold column for each repetition: ``fold``, then ``fold_2``, ``fold_3``... dealt anew."""
    names = ["fold", *[f"fold_{r}" for r in range(2, reps + 1)]]
    for r, name in enumerate(names):
        df = with_folds(df, key, folds, seed="fold" if not r else f"fold {r + 1}", name=name)
    return df, names


def model_search(
    data: DataFrame,
    columns: Sequence[str],
    label: str,
    *,
    methods: Sequence[str],
    control: Control,
    train: DataFrame | None = None,
    key: str = "id",
    split: str = "split",
    length: int | None = None,
    folds: int | None = None,
    reps: int | None = None,
    metric: str | None = None,
    group: str | None = None,
    fitted: dict | None = None,
) -> DataFrame:
    """Area under the curve and time of every method on the training and the test rows.

    ``data`` holds key, label, features and split, and is read many times: pass a staged table.
    ``train`` replaces the training rows, for example by balanced ones. All methods are tuned together over the
    folds, each repetition of them, by the metric of ``control``. A method that is not known becomes a row without a score.
    ``elapsedTime`` is the time tasks spent on the method and an equal share of the rest. The result has two rows
    per method, and with ``group`` for each group (column ``group``); ``fitted`` receives the models,
    then keyed by (group, method).
    """
    begin = time.monotonic()
    spark = data.sparkSession
    base = train if train is not None else data.where(F.col(split) == "traindata")
    base, names = with_repeated_folds(base, [key] if key in base.columns else columns, folds or control.folds, reps or control.reps)
    # Written down: a fold hashed from many columns must not travel through the plans of what reads it.
    base = stage(base, "folds")
    status = {}
    for method in methods:
        try:
            status[method] = known_method(method)
        except KeyError as error:
            status[method] = error
    known = {m: name for m, name in status.items() if isinstance(name, str)}
    rows = []
    if known:
        fits = fit_all(base, columns, label, list(known.values()), folds=names, count=folds or control.folds, length=length or control.length, group=group)
        fits.tune(base, metric or control.metric)
        scored = data.where(F.col(split).isin("traindata", "testdata"))
        areas = {}
        for g in fits.groups:
            models = {f"p_{m}": model for m, model in fits.final(g).items()}
            long = long_scores(scored.where(group_column(group) == g), [split, label], models)
            for r in roc_auc(long, "score", label, by=[split, "model"]).collect():
                areas[g, r["model"].removeprefix("p_"), r[split]] = r["auc"]
            if fitted is not None:
                fitted.update({m if group is None else (g, m): fits.final(g)[name] for m, name in known.items()})
        rest = max(time.monotonic() - begin - sum(fits.elapsed.values()), 0.0) / max(1, len(known) * len(fits.groups))
        for g in fits.groups:
            for m, name in known.items():
                took = fits.elapsed.get((g, name), 0.0) + rest
                rows += [(g, m, part, areas.get((g, name, f"{part}data")), took, "ok") for part in ("train", "test")]
    for m, error in status.items():
        if m not in known:
            rows += [("", m, part, None, 0.0, f"{type(error).__name__}: {error}"[:140]) for part in ("train", "test")]
    out = spark.createDataFrame(rows, "group string, " + RESULT_SCHEMA)
    return out if group is not None else out.drop("group")


def model_dissimilarity(df: DataFrame, label: str, scores: Sequence[str], *, cut: float = 0.5) -> DataFrame:
    """Jaccard distance between the sets of rows each pair of models gets wrong.

    All pairs of models are counted in one pass over the rows.
    """
    scores = list(scores)
    wrong = {s: (F.col(s) >= cut) != (F.col(label) == 1) for s in scores}
    pairs = [(a, b) for i, a in enumerate(scores) for b in scores[i + 1 :]]
    counts = df.agg(
        *[F.count_if(wrong[a] & wrong[b]).alias(f"both{i}") for i, (a, b) in enumerate(pairs)],
        *[F.count_if(wrong[a] | wrong[b]).alias(f"any{i}") for i, (a, b) in enumerate(pairs)],
    )
    rows = [
        F.struct(
            F.lit(a).alias("model_a"),
            F.lit(b).alias("model_b"),
            F.coalesce(F.lit(1.0) - F.try_divide(F.col(f"both{i}"), F.col(f"any{i}")), F.lit(0.0)).alias("distance"),
        )
        for i, (a, b) in enumerate(pairs)
    ]
    return counts.select(F.inline(F.array(*rows)))


def dissimilar_models(distances: DataFrame, n: int) -> list[str]:
    """``n`` models far apart: the farthest pair, then always the one farthest from those taken.

    ``distances`` has one row per pair of models.
    """
    far = {}
    for r in distances.collect():
        far[r["model_a"], r["model_b"]] = far[r["model_b"], r["model_a"]] = r["distance"]
    names = sorted({a for a, _ in far})
    if n >= len(names):
        return names
    taken = list(max(sorted(far), key=lambda p: far[p]))[:n]
    while len(taken) < n:
        rest = [m for m in names if m not in taken]
        taken.append(max(rest, key=lambda m: min(far[m, t] for t in taken)))
    return taken
