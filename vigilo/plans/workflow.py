"""From search results to a scored cohort: choose methods, build four ensembles, use the best."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.operators import balance, cleaning, evaluate, features, peers, ranking
from vigilo.plans import ensemble, search
from vigilo.plans.batched import known_method
from vigilo.plans.blocks import group_column
from vigilo.plans.concurrent import together
from vigilo.plans.control import Control
from vigilo.plans.fitted import ROW_SCHEMA, Fitted, with_columns
from vigilo.sources import artifacts
from vigilo.sources.tables import stage

ENSEMBLES = ("top_weighted", "top_stacked", "dissimilar_weighted", "dissimilar_stacked")
#: Depths a stacker is tuned over at most.
STACK_DEPTHS = 3


def prepare_pool(cohorts: DataFrame, group: Sequence[str], *, target: bool = True, **measures) -> DataFrame:
    """Assembled cohorts to complete, recoded rows with peer statistics.

    With ``target`` the rows whose outcome is unknown leave and the 0/1 outcome is added.
    """
    enriched = peers.peer_enriched(cohorts, group, **measures)
    complete = cleaning.complete_cases(cleaning.clean_pool(enriched))
    return cleaning.binary_outcome(complete) if target else complete


def training_rows(
    data: DataFrame, columns: Sequence[str], label: str, control: Control, *, key: str, minority: int | None = None, by: str | None = None,
) -> DataFrame:
    """Training rows of a split table, balanced if the mode asks for it, written down once.

    ``minority`` is the class that is over-sampled; the smaller one unless given. With ``by`` each group (a grade, of
    which there are a few) is balanced on its own.
    """
    train = data.where("split = 'traindata'")
    if minority is None:
        minority = smaller_class(train, label)
    if control.upsample == "SMOTE":
        if by is None:
            train = balance.smote(train, columns, label, key, minority=minority).drop("source")
        else:
            found = [r[0] for r in train.select(by).distinct().collect()]

            def one(g) -> DataFrame:
                mine = train.where(F.col(by).eqNullSafe(F.lit(g)))
                return balance.smote(mine, columns, label, key, minority=minority).drop("source").withColumn(by, F.lit(g).cast(train.schema[by].dataType))

            parts = together(data.sparkSession, [partial(one, g) for g in sorted(found, key=str)])
            train = reduce(DataFrame.unionByName, parts)
    return stage(train.select(*columns, label, *([by] if by else [])), "training")


def smaller_class(train: DataFrame, label: str) -> int:
    """The label value with fewer rows; the larger value of equally frequent ones."""
    counts = train.where(F.col(label).isNotNull()).groupBy(F.col(label).cast("int").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return min(((r["n"], -r["v"]) for r in counts.collect()), default=(0, -1))[1] * -1


def smaller_class_target(data: DataFrame, label: str, target: str = "target") -> DataFrame:
    """Add a 0/1 target that is 1 for the class with fewer training rows, so a high score means risk."""
    return data.withColumn(target, (F.col(label) == smaller_class(data.where("split = 'traindata'"), label)).cast("int"))


def choose_methods(
    results: DataFrame, grade: int, *, n: int = 8, distances: DataFrame | None = None
) -> tuple[list[str], list[str]]:
    """The ``n`` most efficient methods within the time budget, and ``n`` that err differently.

    ``distances`` comes from :func:`vigilo.plans.search.model_dissimilarity`, with ``p_<method>``
    as names; without it the second list is empty.
    """
    test = results.where("grp = 'test' AND auc IS NOT NULL").select("method", "auc", "elapsedTime")
    best = ranking.budget_topn(
        test, "method", elapsed="elapsedTime", grade=grade, n=n,
        efficiency_col=ranking.efficiency(F.col("auc"), F.col("elapsedTime")),
    )
    top = [r["method"] for r in best.collect()]
    if distances is None:
        return top, []
    in_time = {r["method"] for r in test.where(F.col("elapsedTime") < ranking.time_budget(grade)).collect()}
    usable = distances.where(
        F.col("model_a").isin(*[f"p_{m}" for m in in_time]) & F.col("model_b").isin(*[f"p_{m}" for m in in_time])
    )
    return top, [m.removeprefix("p_") for m in search.dissimilar_models(usable, n)]


@dataclass
class Members:
    """Base models of one group with the weights and stackers of its ensembles."""

    models: dict[str, Fitted] = field(default_factory=dict)
    weights: dict[str, dict[str, float]] = field(default_factory=dict)
    stackers: dict[str, Fitted] = field(default_factory=dict)

    def score(self, x: np.ndarray, columns: Sequence[str]) -> dict[str, np.ndarray]:
        """Score of every ensemble and, as ``<name>_se``, the spread of its base models."""
        base = {f"p_{m}": f.score(x[:, [columns.index(c) for c in f.columns]]) for m, f in self.models.items()}
        out = {}
        for name, weights in self.weights.items():
            total = sum(weights.values())
            mean = sum(base[m] * (w / total) for m, w in weights.items())
            out[name], out[f"{name}_se"] = mean, np.sqrt(sum((base[m] - mean) ** 2 * (w / total) for m, w in weights.items()))
        for name, stacker in self.stackers.items():
            out[name] = stacker.score(np.column_stack([base[c] for c in stacker.columns]))
            out[f"{name}_se"] = out.get(f"{name.replace('stacked', 'weighted')}_se", np.full(len(x), np.nan))
        return out


@dataclass
class Ensembles:
    """The members of each group (a single one, named by the empty text, without ``group``).

    :func:`save_bundle` writes them with all that scoring needs.
    """

    members: dict[str, Members] = field(default_factory=dict)
    group: str | None = None

    @property
    def names(self) -> list[str]:
        return [n for n in ENSEMBLES if any(n in m.weights or n in m.stackers for m in self.members.values())]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the score of each ensemble and the spread of its base models; rows of an unknown group get none."""
        columns = list(dict.fromkeys(c for m in self.members.values() for f in m.models.values() for c in f.columns))
        titles = [t for n in self.names for t in (n, f"{n}_se")]
        members = self.members

        def work(batch, x):
            group = np.array(batch.column("__g").to_pylist(), dtype=object)
            out = np.full((len(x), len(titles)), np.nan)
            for g in set(group) & members.keys():
                rows = np.flatnonzero(group == g)
                for name, score in members[g].score(x[rows], columns).items():
                    out[rows, titles.index(name)] = score
            return out

        return with_columns(df.withColumn("__g", group_column(self.group)), titles, columns, work).drop("__g")


@dataclass
class Bundle:
    """All that another run needs to score a cohort: read back from a path alone."""

    built: Ensembles
    scaler: DataFrame
    valid: DataFrame
    columns: list[str] = field(default_factory=list)
    binary: list[str] = field(default_factory=list)
    levels: dict[str, list[str]] = field(default_factory=dict)
    label: str = ""
    chosen: dict[str, tuple[str, float]] = field(default_factory=dict)


_MANIFEST = "kind string, grp string, name string, text string, number double"


def save_bundle(
    built: Ensembles, path: str, *, scaler: DataFrame, valid: DataFrame, columns: Sequence[str] = (), binary: Sequence[str] = (),
    levels: Mapping[str, Sequence[str]] | None = None, label: str = "", chosen: Mapping[str, tuple[str, float]] | None = None,
) -> None:
    """Ensembles, scaler, validation rows and a manifest in one folder, so that another run can score from the path.

    The manifest has one row for each feature column (``column``), which of them are binary (``binary``), every
    level of a text column (``level``), the group column (``group``), the label (``label``) and, per group, the
    ensemble that scores it with its threshold (``chosen``).
    """
    spark = scaler.sparkSession
    models = [("models", g, n, "", 0.0, *f.to_row()) for g, m in built.members.items() for n, f in m.models.items()]
    models += [("stackers", g, n, "", 0.0, *f.to_row()) for g, m in built.members.items() for n, f in m.stackers.items()]
    models += [("weights", g, n, name, w, "", "", [], "", b"") for g, m in built.members.items() for name, ws in m.weights.items() for n, w in ws.items()]
    manifest = [("column", "", c, None, float(k)) for k, c in enumerate(columns)] + [("binary", "", c, None, None) for c in binary]
    manifest += [("level", "", c, v, float(k)) for c, vs in (levels or {}).items() for k, v in enumerate(vs)]
    manifest += [("label", "", label, None, None)] + ([("group", "", built.group, None, None)] if built.group else [])
    manifest += [("chosen", g, name, None, float(t)) for g, (name, t) in (chosen or {}).items()]
    tables = {"models": spark.createDataFrame(models, f"part string, grp string, name string, ensemble string, weight double, {ROW_SCHEMA}"),
              "manifest": spark.createDataFrame(manifest, _MANIFEST), "scaler": scaler, "valid": valid}
    for name, one in tables.items():
        artifacts.save_table(one, f"{path}/{name}", partition_by=())


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    """What :func:`save_bundle` wrote."""
    parts = artifacts.load_table(spark, f"{path}/models").collect()
    manifest = artifacts.load_table(spark, f"{path}/manifest").collect()
    rows = lambda kind: sorted((r for r in manifest if r["kind"] == kind), key=lambda r: (r["name"], r["number"] or 0.0))
    built = Ensembles({}, next((r["name"] for r in rows("group")), None))
    for r in parts:
        mine = built.members.setdefault(r["grp"], Members())
        if r["part"] == "weights":
            mine.weights.setdefault(r["ensemble"], {})[r["name"]] = r["weight"]
        else:
            getattr(mine, r["part"])[r["name"]] = Fitted.from_row(r["method"], r["kind"], r["columns"], r["setting"], r["arrays"])
    levels: dict[str, list[str]] = {}
    for r in rows("level"):
        levels.setdefault(r["name"], []).append(r["text"])
    return Bundle(
        built, artifacts.load_table(spark, f"{path}/scaler"), artifacts.load_table(spark, f"{path}/valid"),
        [r["name"] for r in sorted(rows("column"), key=lambda r: r["number"])], [r["name"] for r in rows("binary")], levels,
        next((r["name"] for r in rows("label")), ""), {r["grp"]: (r["name"], r["number"]) for r in rows("chosen")})


def construct_models(
    train: DataFrame, columns: Sequence[str], label: str, *, top: Sequence[str] | Mapping[str, Sequence[str]],
    dissimilar: Sequence[str] | Mapping[str, Sequence[str]], folds: int = 10, rounds: int = 20, length: int = 1, by: str | None = None,
) -> Ensembles:
    """Weighted and stacked ensembles of two lists of methods, for each group of ``by`` if given.

    Each method is tuned over ``length`` settings on the folds and fitted for every fold and on all rows, all of them
    and all groups together. Weights and stackers learn from held-out scores only. With ``by`` the lists may differ by group.
    """
    lists = [*(top.values() if isinstance(top, Mapping) else [top]), *(dissimilar.values() if isinstance(dissimilar, Mapping) else [dissimilar])]
    methods = list(dict.fromkeys(m for names in lists for m in names))
    folded = stage(search.with_folds(train, columns, folds), "folds")
    fits = ensemble.tune_members(folded, columns, label, methods, fold="fold", folds=folds, length=length, group=by)
    held = stage(ensemble.held_scores(fits, folded, methods, key=None, fold="fold"), "held")
    out = Ensembles({g: Members({m: fits.final(g)[known_method(m)] for m in methods}) for g in fits.groups}, by)
    stacks = []
    for part, names, stacker in (("top", top, "rf"), ("dissimilar", dissimilar, "gbm")):
        per = {g: [f"p_{m}" for m in (names.get(g, []) if isinstance(names, Mapping) else names)] for g in fits.groups}
        scores = list(dict.fromkeys(s for some in per.values() for s in some))
        if not scores:
            continue
        found = ensemble.greedy_ensemble(held, label, scores, rounds=rounds, group=by, allowed=per if by else None).collect()
        for r in found:
            if r["weight"] > 0:
                out.members[r[by] if by else ""].weights.setdefault(f"{part}_weighted", {})[r["model"]] = r["weight"]
        stacks += [(g, f"{part}_stacked", stacker, some) for g, some in per.items() if some]

    def stack(g: str, stacker: str, scores: list[str]) -> Fitted:
        mine = held.where(group_column(by) == g)
        return ensemble.stacked_ensemble(mine, label, scores, method=stacker, fold="fold", folds=folds, length=min(length, STACK_DEPTHS))

    made = together(train.sparkSession, [partial(stack, g, stacker, scores) for g, _, stacker, scores in stacks])
    for (g, name, _, _), one in zip(stacks, made, strict=True):
        out.members[g].stackers[name] = one
    return out


def _long_scores(scored: DataFrame, label: str, by: Sequence[str]) -> DataFrame:
    names = [n for n in ENSEMBLES if n in scored.columns]
    rows = F.array(*[F.struct(F.lit(n).alias("model"), F.col(n).alias("score")) for n in names])
    return scored.select(label, *by, F.inline(rows))


def ensemble_areas(scored: DataFrame, label: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Area under the curve ``(model, auc)`` of every ensemble on rows it was not trained on, per group of ``by``."""
    return evaluate.roc_auc(_long_scores(scored, label, by), "score", label, by=[*by, "model"])


def choose_ensembles(built: Ensembles, valid: DataFrame, label: str) -> dict[str, tuple[str, float]]:
    """Per group the ensemble with the largest area on the validation rows, and its best threshold there.

    A group whose validation rows hold one class only takes the first ensemble and a threshold of one half.
    """
    if not built.names:
        return {}
    scored = built.transform(valid).select(label, group_column(built.group).alias("grp"), *built.names)
    long = stage(_long_scores(scored, label, ["grp"]), "scored")
    areas = {(r["grp"], r["model"]): r["auc"] for r in evaluate.roc_auc(long, "score", label, by=["grp", "model"]).collect()}
    cuts = {(r["grp"], r["model"]): r["threshold"] for r in evaluate.best_threshold(long, "score", label, by=["grp", "model"]).collect()}
    out = {}
    for g, members in built.members.items():
        names = sorted({*members.weights, *members.stackers})
        if names:
            best = min(names, key=lambda n: (-(areas.get((g, n)) if areas.get((g, n)) is not None else -1.0), n))
            out[g] = (best, cuts.get((g, best), 0.5))
    return out


def best_scores(built: Ensembles, chosen: Mapping[str, tuple[str, float]], cohort: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` with ``pred``, ``se``, ``bestThresh`` and ``model`` of the ensemble chosen for the row's group."""
    out = built.transform(cohort).withColumn("__g", group_column(built.group))

    def pick(value) -> Column:
        cases = F.lit(None)
        for g, (name, cut) in chosen.items():
            cases = F.when(F.col("__g") == g, value(name, cut)).otherwise(cases)
        return cases

    return out.select(
        *keep, pick(lambda n, _: F.col(n)).cast("double").alias("pred"), pick(lambda n, _: F.col(f"{n}_se")).cast("double").alias("se"),
        pick(lambda _, c: F.lit(c)).cast("double").alias("bestThresh"), pick(lambda n, _: F.lit(n)).cast("string").alias("model"))


def raw_predictions(
    built: Ensembles, data: DataFrame, cohort: DataFrame, columns: Sequence[str], label: str, *, key: str
) -> DataFrame:
    """Score a cohort by the ensemble that does best on the validation rows, in each group.

    The threshold is the best one on those rows too. Output: key, ``pred``, ``se``,
    ``bestThresh`` and the features, which are brought into the order of training first.
    """
    chosen = choose_ensembles(built, data.where("split = 'validdata'"), label)
    group = [built.group] if built.group else []
    aligned = features.align_columns(cohort, columns, keep=[key, *group])
    out = best_scores(built, chosen, aligned, [key, *group, *columns])
    return out.select(key, *group, "pred", "se", "bestThresh", "model", *columns)
