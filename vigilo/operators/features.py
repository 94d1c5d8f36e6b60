"""Model matrix, scaling, alignment and derived terms."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilo.functions import fixed
from vigilo.functions.hashing import unit_hash
from vigilo.operators.groups import table_stats, with_group_stats
from vigilo.operators.ordering import row_numbers


def key_columns(df: DataFrame, *, extra: Sequence[str] = ("SCHOOL_YEAR",)) -> list[str]:
    """Columns that identify rather than describe: ``KEY`` in the name, or named in ``extra``."""
    return [c for c in df.columns if "KEY" in c or c in extra]


def levels(df: DataFrame, columns: Sequence[str], ) -> dict[str, list[str]]:
    """Sorted distinct values of each text column, from one pass over the table.

    Each value becomes a column name of the matrix, so the schema bounds what travels. For columns of
    very many levels use :func:`level_vectors`, which needs no column per level.
    """
    columns = list(columns)
    if not columns:
        return {}
    pairs = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]))
    )
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in pairs.where("v IS NOT NULL").distinct().toLocalIterator():
        found[row["c"]].append(row["v"])
    return {c: sorted(v) for c, v in found.items()}


def level_vectors(df: DataFrame, train: DataFrame, column: str, *, name: str | None = None) -> DataFrame:
    """Indicators of a text column's levels in ``train`` as a sparse vector; nothing is collected.

    Levels are numbered in sorted order by a join, so a column may have any number of them. A level that
    ``train`` never saw and a missing one get the zero vector, as the reference level has no meaning here.
    """
    seen = train.where(F.col(column).isNotNull()).select(F.col(column).alias("__level")).distinct()
    digits = F.conv(F.substring(F.sha2(F.col("__level"), 256), 1, 13), 16, 10).cast("double")
    numbered = row_numbers(seen.withColumn("__digits", digits), "__digits", "__number").select("__level", "__number")
    count = numbered.count()
    joined = df.join(numbered, F.col(column) == F.col("__level"), "left")
    known = F.col("__number").isNotNull()
    at = F.when(known, F.array((F.col("__number") - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    one = F.when(known, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>"))
    vector = F.struct(F.lit(count).alias("size"), at.alias("indices"), one.alias("values"))
    return joined.withColumn(name or f"{column}_levels", vector).drop("__level", "__number")


def text_columns(df: DataFrame, skip: Sequence[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip
    ]


def model_matrix(
    df: DataFrame,
    *,
    target: str | None = None,
    keep: Sequence[str] = (),
    exclude: Sequence[str] | None = None,
    known_levels: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Numeric columns only: text columns become 0/1 columns named ``<column><level>``.

    The first sorted level of each column is the baseline and gets no column. Key columns leave
    unless listed in ``keep``. The target, if any, comes first. Pass the training levels as
    ``known_levels`` to give a scoring cohort the same columns.
    """
    exclude = list(key_columns(df) if exclude is None else exclude)
    skip = {*exclude, *keep, target}
    inputs = [f for f in df.schema.fields if f.name not in skip]
    text = [f.name for f in inputs if isinstance(f.dataType, T.StringType)]
    known = dict(known_levels) if known_levels is not None else levels(df, text)
    out: list[Column] = [F.col(c) for c in keep]
    if target:
        out.append(F.col(target).cast("double").alias(target))
    for f in inputs:
        if f.name in text:
            out += [
                (F.col(f.name) == level).cast("double").alias(f"{f.name}{level}")
                for level in list(known[f.name])[1:]
            ]
        else:
            out.append(F.col(f.name).cast("double").alias(f.name))
    return df.select(*out)


def find_binary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column, whether it has fewer than three distinct values.

    A column is binary exactly when every value equals its smallest or its largest one, so two
    plain aggregations answer it without counting distinct values.
    """
    columns = list(columns)
    ends = table_stats(
        df,
        {f"lo{i}": F.min(c) for i, c in enumerate(columns)} | {f"hi{i}": F.max(c) for i, c in enumerate(columns)},
    )
    between = df.agg(
        *[
            F.coalesce(
                F.bool_or((F.col(c) != ends[f"lo{i}"]) & (F.col(c) != ends[f"hi{i}"])),
                F.lit(False),
            ).alias(f"b{i}")
            for i, c in enumerate(columns)
        ]
    )
    rows = [
        F.struct(F.lit(c).alias("column"), (~F.col(f"b{i}")).alias("is_binary"))
        for i, c in enumerate(columns)
    ]
    return between.select(F.inline(F.array(*rows)))


def binary_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    found = {r["column"] for r in find_binary(df, columns).collect() if r["is_binary"]}
    return [c for c in columns if c in found]


def split_shares(mode: str) -> tuple[float, float]:
    """Train and validation share of a mode, alike at every size; other modes split like DEV."""
    return fixed.SPLIT_SHARES.get(mode, fixed.SPLIT_SHARES["DEV"])


def three_way_split(
    df: DataFrame,
    key: Sequence[str],
    *,
    mode: str = "PROD",
    shares: tuple[float, float] | None = None,
    seed: int | str = "",
    name: str = "split",
) -> DataFrame:
    """Assign each row to ``traindata``, ``testdata`` or ``validdata`` by a hash of its key.

    The assignment never changes between runs or retries and needs no shuffle; the shares are those
    of the mode unless given.
    """
    train, valid = (F.lit(s) for s in shares or split_shares(mode))
    parts = [F.col(c) for c in key]
    u = unit_hash(*parts, *([F.lit(str(seed))] if seed != "" else []))
    return df.withColumn(
        name,
        F.when(u < train, "traindata").when(u < train + valid, "validdata").otherwise("testdata"),
    )


def fit_scaler(
    df: DataFrame,
    continuous: Sequence[str],
    binary: Sequence[str] = (),
    *,
    split: str | None = None,
    fit_on: str = "traindata",
) -> DataFrame:
    """Mean and standard deviation per column, ``(column, kind, mean, std)``, from one pass.

    Only the rows of ``fit_on`` count when a split column is given. Binary columns keep a
    standard deviation of 1: they are centred only.
    """
    rows = df.where(F.col(split) == fit_on) if split else df
    stats = rows.agg(
        *[F.avg(c).alias(f"m_{i}") for i, c in enumerate([*continuous, *binary])],
        *[F.stddev_samp(c).alias(f"s_{i}") for i, c in enumerate(continuous)],
    )
    entries = []
    for i, c in enumerate([*continuous, *binary]):
        scaled = i < len(continuous)
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                F.lit("continuous" if scaled else "binary").alias("kind"),
                F.col(f"m_{i}").alias("mean"),
                (F.col(f"s_{i}") if scaled else F.lit(1.0)).alias("std"),
            )
        )
    return stats.select(F.inline(F.array(*entries)))


def _stored(scaler: DataFrame) -> dict[str, tuple[Column, Column]]:
    """Mean and standard deviation of each column as constants; one row per column is read."""
    number = lambda v: F.lit(v).cast("double")
    return {r["column"]: (number(r["mean"]), number(r["std"])) for r in scaler.collect()}


def standardize(
    df: DataFrame,
    scaler: DataFrame,
    columns: Sequence[str],
    *,
    binary: Sequence[str] = (),
    per_split: str | None = None,
) -> DataFrame:
    """Centre and scale ``columns``, centre ``binary``.

    With ``per_split`` binary columns are centred on the mean of their own split instead of the
    stored one.
    """
    stored = _stored(scaler)
    done = {c: F.try_divide(F.col(c) - stored[c][0], stored[c][1]) for c in columns}
    if per_split is None:
        return df.withColumns(done | {c: F.col(c) - stored[c][0] for c in binary})
    out = df.withColumns(done)
    if not binary:
        return out
    wide = with_group_stats(out, [per_split], {f"__m_{c}": F.avg(c) for c in binary})
    return wide.withColumns({c: F.col(c) - F.col(f"__m_{c}") for c in binary}).select(*df.columns)


def unstandardize(df: DataFrame, scaler: DataFrame, columns: Sequence[str], *, binary: Sequence[str] = ()) -> DataFrame:
    """Undo :func:`standardize`: back to the original units."""
    stored = _stored(scaler)
    back = {c: F.col(c) * stored[c][1] + stored[c][0] for c in columns}
    return df.withColumns(back | {c: F.col(c) + stored[c][0] for c in binary})


def uncenter(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Give centred 0/1 columns their 0 and 1 back without knowing their mean.

    The distance added is that of the value at or below zero, which stood for 0.
    """
    low = table_stats(df, {c: F.min(F.when(F.col(c) <= 0, F.col(c))) for c in columns})
    return df.withColumns({c: F.col(c) + F.abs(low[c]) for c in columns})


def align_columns(df: DataFrame, columns: Sequence[str], *, keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the training columns in order; a column the frame lacks is zero."""
    have = set(df.columns)
    return df.select(
        *keep, *[F.col(c) if c in have else F.lit(0.0).alias(c) for c in columns]
    )


def class_balance(df: DataFrame, label: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Rows per class with the class names by size: the larger one first.

    Equal sizes are ordered by the label itself.
    """
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))
    size = Window.partitionBy(*(by or [F.lit(0)])).orderBy(F.desc("n"), F.col(label))
    return counts.withColumn("size_rank", F.row_number().over(size).cast("long"))


def class_labels(
    df: DataFrame,
    label: str,
    *,
    train: Column | None = None,
    names: Sequence[str] = fixed.CLASS_LABELS,
    name: str = "class",
) -> DataFrame:
    """Name the two classes by their size in the training rows: larger first."""
    rows = df.where(train) if train is not None else df
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    biggest = F.max_by(F.col(label), F.struct(F.col("n"), -F.col(label)))
    biggest = table_stats(counts, {"v": biggest})["v"]
    return df.withColumn(name, F.when(F.col(label) == biggest, names[0]).otherwise(names[1]))


def poly_terms(df: DataFrame, powers: Mapping[str, int], products: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Powers ``<column>^2``.. as ``<column>_2``.. and products as ``<a>_x_<b>``."""
    made = {
        f"{c}_{p}": F.pow(F.col(c), F.lit(float(p))) for c, top in powers.items() for p in range(2, top + 1)
    }
    made |= {f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in products}
    return df.withColumns(made)


def known_levels(df: DataFrame, train: DataFrame, column: str) -> DataFrame:
    """Replace levels the training data never saw, and missing ones, by its most frequent level.

    Ties go to the level that sorts first.
    """
    counts = train.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    first = counts.groupBy("n").agg(F.min(column).alias("v"))
    best = table_stats(first, {"v": F.max_by("v", "n")})["v"]
    seen = counts.select(F.col(column).alias("__seen"))
    joined = df.join(seen, F.col(column) == F.col("__seen"), "left")
    return joined.withColumn(column, F.coalesce("__seen", best)).drop("__seen")


def gram(
    df: DataFrame, columns: Sequence[str], *, weight: str | None = None, intercept: bool = False,
    centre: Sequence[float] | None = None,
) -> np.ndarray:
    """Sums of (weighted) products of all column pairs as a small square array.

    Each task multiplies its own rows and emits one array; arrays are added in two levels, so the
    driver receives a single one, whatever the number of rows and tasks. With ``centre`` that much is
    taken from each column first, which keeps the digits where means are large against the spread.
    """
    columns = list(columns)
    picked = df.select(
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)],
        *([F.col(weight).cast("double").alias("w")] if weight else []),
    )
    d = len(columns) + int(intercept)
    shift = np.zeros(len(columns)) if centre is None else np.asarray(centre, dtype=float)

    def partial(batches):
        total = np.zeros((d, d))
        for pdf in batches:
            x = pdf[[f"x{i}" for i in range(len(columns))]].to_numpy(dtype="float64") - shift
            if intercept:
                x = np.column_stack([np.ones(len(x)), x])
            total += x.T @ (x * pdf["w"].to_numpy()[:, None] if weight else x)
        yield pd.DataFrame({"s": [total.ravel()]})

    def add(batches):
        total = np.zeros(d * d)
        for pdf in batches:
            for s in pdf["s"]:
                total += s
        yield pd.DataFrame({"s": [total]})

    sums = picked.mapInPandas(partial, "s array<double>")
    parts = max(1, math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    once = sums.repartition(parts).mapInPandas(add, "s array<double>").coalesce(1).mapInPandas(add, "s array<double>")
    return np.array(once.first()["s"]).reshape(d, d)


def independent_columns(df: DataFrame, columns: Sequence[str], *, tolerance: float = 1e-8) -> list[str]:
    """Columns left after dropping each one that the columns before it already determine."""
    columns = list(columns)
    g = gram(df, columns)
    scale = np.sqrt(np.diag(g))
    live = scale > 0
    r = np.where(live[:, None] & live[None, :], g / np.where(np.outer(scale, scale) == 0, 1, np.outer(scale, scale)), 0)
    kept: list[int] = []
    for j in range(len(columns)):
        if not live[j]:
            continue
        if kept:
            a = r[np.ix_(kept, kept)]
            b = r[kept, j]
            left = r[j, j] - b @ np.linalg.solve(a, b)
        else:
            left = r[j, j]
        if left > tolerance:
            kept.append(j)
    return [columns[j] for j in kept]


def drop_collinear(df: DataFrame, columns: Sequence[str], *, tolerance: float = 1e-8) -> DataFrame:
    """Drop linearly dependent columns; the first of dependent columns stays."""
    kept = set(independent_columns(df, columns, tolerance=tolerance))
    return df.drop(*[c for c in columns if c not in kept])
