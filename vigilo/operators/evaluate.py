"""ROC curves, thresholds, confusion, percentiles, intervals and simple regression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.functions import fixed
from vigilo.operators.groups import join_groups, table_stats
from vigilo.operators.ordering import prefix_sums, quantiles, value_counts, with_value_buckets
from vigilo.sources.tables import stage


def _score_counts(df: DataFrame, score: str, label: str, by: Sequence[str]) -> DataFrame:
    """Positives and negatives per distinct score, written down once.

    Scores are often costly to compute; everything after works on these counts.
    """
    rows = df.where(F.col(score).isNotNull() & F.col(label).isin(0, 1))
    counts = rows.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return stage(counts, "scores")


def _cumulated(df: DataFrame, score: str, label: str, by: Sequence[str]) -> DataFrame:
    counts = with_value_buckets(_score_counts(df, score, label, by), "score")
    return prefix_sums(
        counts, "score", {"pos": "pos_upto", "neg": "neg_upto"}, by=by,
        totals={"pos": "P", "neg": "N"}, previous="below",
    )


def _points(cum: DataFrame, by: Sequence[str]) -> DataFrame:
    """Every threshold with its rates; the highest score also closes the curve at infinity."""
    below, score = F.col("below"), F.col("score")
    called = F.struct(
        F.when(below.isNull(), F.lit(float("-inf"))).otherwise((below + score) / 2).alias("threshold"),
        F.try_divide(F.col("P") - F.col("pos_upto") + F.col("pos"), F.col("P")).alias("sensitivity"),
        F.try_divide(F.col("neg_upto") - F.col("neg"), F.col("N")).alias("specificity"),
    )
    none = F.struct(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("sensitivity"), F.lit(1.0).alias("specificity")
    )
    last = F.col("pos_upto") + F.col("neg_upto") == F.col("P") + F.col("N")
    return cum.select(*by, "P", "N", F.inline(F.when(last, F.array(called, none)).otherwise(F.array(called))))


def roc_curve(df: DataFrame, score: str, label: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Sensitivity and specificity at every threshold that separates two distinct scores.

    A row is called positive when its score is above the threshold. Thresholds lie halfway
    between neighbouring scores, with minus and plus infinity at the ends.
    """
    by = list(by)
    points = _points(_cumulated(df, score, label, by), by)
    return points.select(*by, "threshold", "sensitivity", "specificity")


def roc_auc(df: DataFrame, score: str, label: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Area under the curve as the share of correctly ordered pairs, ties counting half."""
    by = list(by)
    cum = _cumulated(df, score, label, by)
    won = F.sum(
        F.col("neg").cast("double")
        * (F.col("P") - F.col("pos_upto") + F.col("pos").cast("double") / 2)
    )
    pairs = F.max(F.col("P").cast("double") * F.col("N"))
    return cum.groupBy(*by).agg(
        F.try_divide(won, pairs).alias("auc"), F.max("P").alias("positives"), F.max("N").alias("negatives")
    )


def best_threshold(
    df: DataFrame, score: str, label: str, *, by: Sequence[str] = (), cost: float = 1.0
) -> DataFrame:
    """The threshold nearest to the top left corner, weighted by cost and prevalence.

    The smallest of equally near thresholds wins.
    """
    by = list(by)
    points = _points(_cumulated(df, score, label, by).where("P > 0 AND N > 0"), by)
    prevalence = F.col("P") / (F.col("P") + F.col("N"))
    ratio = (F.lit(1.0) - prevalence) / (F.lit(cost) * prevalence)
    miss, alarm = 1 - F.col("sensitivity"), 1 - F.col("specificity")
    measured = points.withColumn("distance", miss * miss + ratio * alarm * alarm)
    best = F.min_by(F.struct("threshold", "sensitivity", "specificity", "distance"), F.struct("distance", "threshold"))
    return measured.groupBy(*by).agg(best.alias("b")).select(*by, "b.*")


def best_model(df: DataFrame, score: str, label: str, *, model: str) -> DataFrame:
    """The model with the largest area under the curve; the first name wins a tie."""
    areas = roc_auc(df, score, label, by=[model])
    return areas.orderBy(F.desc_nulls_last("auc"), model).limit(1).select(model, "auc")


def confusion(df: DataFrame, score: str, label: str, threshold: Column, *, by: Sequence[str] = ()) -> DataFrame:
    """Counts of true and false calls at a threshold, with the usual rates."""
    called = F.col(score) >= threshold
    truth = F.col(label) == 1
    counts = df.groupBy(*by).agg(
        F.count_if(called & truth).alias("tp"),
        F.count_if(called & ~truth).alias("fp"),
        F.count_if(~called & truth).alias("fn"),
        F.count_if(~called & ~truth).alias("tn"),
    )
    c = F.col
    total = c("tp") + c("fp") + c("fn") + c("tn")
    observed = F.try_divide(c("tp") + c("tn"), total)
    chance = F.try_divide(
        (c("tp") + c("fp")).cast("double") * (c("tp") + c("fn"))
        + (c("fn") + c("tn")).cast("double") * (c("fp") + c("tn")),
        total.cast("double") * total,
    )
    return counts.select(
        *by, "tp", "fp", "fn", "tn",
        observed.alias("accuracy"),
        F.try_divide(observed - chance, 1 - chance).alias("kappa"),
        F.try_divide(c("tp"), c("tp") + c("fn")).alias("sensitivity"),
        F.try_divide(c("tn"), c("tn") + c("fp")).alias("specificity"),
        F.try_divide(c("tp"), c("tp") + c("fp")).alias("precision"),
        F.try_divide(c("tn"), c("tn") + c("fn")).alias("negative_value"),
    )


def ecdf_rank(df: DataFrame, columns: dict[str, str], *, by: Sequence[str] = ()) -> DataFrame:
    """Percentile rank 0..100 of each value within its column and group; missing values stay missing.

    The rank is a step function with at most 101 steps. The exact step positions of all columns
    come from one pass of value counts and running sums; the steps of a group join its rows as short
    arrays. Without ``by`` they enter as constants and the rows are ranked without being moved.
    """
    by = list(by)
    keys = [F.col(c).alias(f"__b_{c}") for c in by]
    values = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    within = [f"__b_{c}" for c in by] + ["column"]
    counts = value_counts(df.select(*keys, F.inline(values)), "value", by=within)
    cum = prefix_sums(
        with_value_buckets(counts, "value"), "value", {"n": "upto"}, by=within, totals={"n": "total"}
    )
    rank = F.floor(F.col("upto") / F.col("total") * 100)
    found = cum.groupBy(*within, rank.alias("rank")).agg(F.min("value").alias("start"))
    if by:
        step = F.struct("start", "rank")
        table = found.groupBy(*[F.col(f"__b_{c}").alias(c) for c in by]).agg(
            *[F.array_sort(F.collect_list(F.when(F.col("column") == c, step))).alias(f"__s_{c}") for c in columns]
        )
        parts = {f"__{x}_{c}": F.col(f"__s_{c}.{field}") for c in columns for x, field in (("s", "start"), ("r", "rank"))}
        steps = stage(table.select(*by, *[v.alias(k) for k, v in parts.items()]), "steps")
        ranked = join_groups(df, steps, by, "left").withColumns({f"__at_{c}": F.lit(0) for c in columns})
        for width in (64, 32, 16, 8, 4, 2, 1):  # halving finds how many of the at most 101 steps begin at or below the value
            reached = lambda c: F.get(f"__s_{c}", F.col(f"__at_{c}") + (width - 1)) <= F.col(c).cast("double")
            ranked = ranked.withColumns({f"__at_{c}": F.col(f"__at_{c}") + F.when(reached(c), width).otherwise(0) for c in columns})
        ranked = ranked.withColumns(
            {name: F.when(F.col(c).isNotNull(), F.get(f"__r_{c}", F.col(f"__at_{c}") - 1)) for c, name in columns.items()}
        )
        return ranked.drop(*[f"__{x}_{c}" for c in columns for x in ("s", "r", "at")])
    found = found.collect()
    out = df
    for column, name in columns.items():
        steps = sorted((r["start"], r["rank"]) for r in found if r["column"] == column)
        if steps:
            out = _step_lookup(out, column, [s for s, _ in steps], [int(r) for _, r in steps], name)
        else:
            out = out.withColumn(name, F.lit(None).cast("long"))
    return out


def _step_lookup(df: DataFrame, column: str, starts: list[float], values: list[int], name: str) -> DataFrame:
    splits = [-float("inf"), *starts, float("inf")]
    cut = Bucketizer(splits=splits, inputCol="__v", outputCol="__step", handleInvalid="keep")
    placed = cut.transform(df.withColumn("__v", F.col(column).cast("double")))
    ranks = F.array(*[F.lit(v).cast("long") for v in [values[0], *values]])
    at = F.get(ranks, F.col("__step").cast("int"))
    return placed.withColumn(name, F.when(F.col(column).isNotNull(), at)).drop("__v", "__step")


def group_ci(df: DataFrame, group: str, value: str, *, z: float = fixed.Z_75) -> DataFrame:
    """Lower limit, mean and upper limit of a normal interval of each group's mean."""
    half = F.lit(z) * F.stddev_samp(value) / F.sqrt(F.count(value))
    return df.groupBy(group).agg(
        (F.avg(value) - half).alias("lower"), F.avg(value).alias("mean"), (F.avg(value) + half).alias("upper")
    )


def simple_regression(df: DataFrame, y: str, x: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` per group."""
    return df.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def error_quantiles(
    df: DataFrame, y: str, estimate: str, *, probabilities: Sequence[float] = (0.1, 0.9), by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles of the error relative to the range of ``y``."""
    by = list(by)
    errors = df.select(*by, y, (F.col(y) - F.col(estimate)).alias("__e"))
    found = quantiles(errors, "__e", probabilities, by=by)
    spread = {"__range": F.max(y) - F.min(y)}
    names = {p: f"q{round(p * 100)}" for p in probabilities}
    if by:
        joined = join_groups(found, df.groupBy(*by).agg(spread["__range"].alias("__range")), by)
    else:
        joined = found.withColumns(table_stats(df, spread))
    return joined.select(
        *by, *[F.try_divide(F.col(f"q{i}"), F.col("__range")).alias(names[p]) for i, p in enumerate(probabilities)]
    )
