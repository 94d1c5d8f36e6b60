"""The whole run: training pool to models, models to a scored cohort, scored cohort to the export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.operators import cleaning, features, risk
from vigilo.plans import ensemble, search, workflow
from vigilo.plans.blocks import group_column
from vigilo.plans.control import Control
from vigilo.sources.tables import stage, staging_path


def train_models(
    pool: DataFrame, path: str, *, target: str, key: str, exclude: Sequence[str], control: Control, methods: Sequence[str],
    grade: int, n: int = 8, folds: int | None = None, length: int | None = None, by: str | None = None,
) -> workflow.Ensembles:
    """Search, choose and ensemble on a prepared pool, and save the bundle under ``path``.

    Search and base learners are tuned over ``length`` settings, by default as many as the mode has. A high
    score stands for the smaller class of the training rows. With ``by`` (the grade) every group has a search, methods, weights,
    stackers and a threshold of its own, all fitted together; its time budget is that of the grade its value names,
    that of ``grade`` where it names none.
    """
    extra = [by] if by else []
    levels = features.levels(pool, features.text_columns(pool, [*exclude, key, target, *extra]))
    matrix = features.model_matrix(pool, target=target, keep=[key, *extra], exclude=[*exclude, key, *extra], known_levels=levels)
    data = stage(features.three_way_split(matrix, [key], mode=control.mode), "matrix")
    data = workflow.smaller_class_target(data, target, "risk")
    train = data.where("split = 'traindata'")
    columns = features.independent_columns(train, [c for c in matrix.columns if c not in (key, target, *extra)])
    binary = features.binary_columns(train, columns)
    continuous = [c for c in columns if c not in binary]
    scaler = stage(features.fit_scaler(data, continuous, binary, split="split"), "scaler")
    scaled = stage(features.standardize(data, scaler, continuous, binary=binary).select(key, *extra, "risk", "split", *columns), "scaled")
    train = workflow.training_rows(scaled, columns, "risk", control, key=key, by=by)

    fitted: dict = {}
    results = stage(search.model_search(
        scaled, columns, "risk", methods=methods, control=control, train=train, key=key, length=length, folds=folds, fitted=fitted, group=by), "search")
    tested = scaled.where("split = 'testdata'")
    groups = sorted({g for g, _ in fitted}) if by else [""]
    top, apart = {}, {}
    for g in groups:
        models = {m: f for (k, m), f in fitted.items() if k == g} if by else fitted
        mine = tested.where(group_column(by) == g).select("risk", *columns)
        distances = search.model_dissimilarity(stage(ensemble.apply_models(mine, models), "tested"), "risk", [f"p_{m}" for m in models])
        own = results.where(F.col("group") == g) if by else results
        top[g], apart[g] = workflow.choose_methods(own, _budget_grade(g, grade), n=n, distances=distances)
    built = workflow.construct_models(
        train, columns, "risk", top=top if by else top[""], dissimilar=apart if by else apart[""], folds=folds or control.folds, length=length or control.length, by=by)
    valid = scaled.where("split = 'validdata'")
    workflow.save_bundle(
        built, path, scaler=scaler, valid=valid, columns=columns, binary=binary, levels=levels, label="risk",
        chosen=workflow.choose_ensembles(built, valid, "risk"))
    return built


def _budget_grade(group: str, otherwise: int) -> int:
    try:
        return int(float(group))
    except ValueError:
        return otherwise


def score_pool(cohort: DataFrame, path: str, *, row: str) -> DataFrame:
    """``row``, ``pred``, ``se``, ``bestThresh`` and ``model`` of the complete rows of a cleaned cohort, by a saved bundle.

    Everything comes from the bundle: columns and their order, levels, scaling, models and thresholds.
    """
    bundle = workflow.load_bundle(cohort.sparkSession, path)
    group = [bundle.built.group] if bundle.built.group else []
    matrix = features.model_matrix(cleaning.complete_cases(cohort), keep=[row, *group], exclude=[row, *group], known_levels=bundle.levels)
    aligned = features.align_columns(matrix, bundle.columns, keep=[row, *group])
    scaled = features.standardize(aligned, bundle.scaler, [c for c in bundle.columns if c not in bundle.binary], binary=bundle.binary)
    return workflow.best_scores(bundle.built, bundle.chosen, scaled, [row])


def early_warning(
    pool: DataFrame, cohort: DataFrame, *, target: str, key: str, year: str, grade: str, exclude: Sequence[str], control: Control,
    methods: Sequence[str], budget_grade: int, n: int = 8, folds: int | None = None, length: int | None = None,
    run_time: Column | None = None, path: str | None = None,
) -> DataFrame:
    """Export of a cleaned cohort scored by models of a prepared pool, each grade by models and a threshold of its own.

    ``cohort`` holds the columns of ``pool`` but the outcome, and ``WSN``. Rows with missing values, and those of a grade
    the pool does not hold, get no score and are exported as Missing. The bundle is saved under ``path`` (a new staging folder by
    default) and scoring reads it back.
    """
    path = path or staging_path(pool.sparkSession, "bundle")
    train_models(pool, path, target=target, key=key, exclude=[c for c in exclude if c != grade], control=control, methods=methods, grade=budget_grade, n=n, folds=folds,
                 length=length, by=grade)
    rows = cohort.withColumn("__row", F.concat_ws("|", year, F.col(key).cast("string")))
    described = [c for c in pool.columns if c in rows.columns and (c == grade or c not in (*exclude, key, target))]
    found = stage(score_pool(rows.select("__row", *described), path, row="__row").drop("model"), "predicted")
    scored = stage(rows.join(found, "__row", "left").drop("__row"), "scored")
    banded = risk.risk_bands(scored, F.col("bestThresh"), by=[grade, year])
    return risk.risk_export(banded, grade=F.col(grade).cast("int"), year=F.col(year), run_time=run_time)
