"""Balancing classes: exact up- and down-sampling and synthetic minority rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.functions import fixed
from vigilo.functions.hashing import digest, unit_hash
from vigilo.operators.groups import with_group_stats
from vigilo.operators.nearest import nearest_vectors
from vigilo.operators.ordering import hash_ranks, repeat_rows
from vigilo.sources.tables import stage


def _ranked_with_sizes(df: DataFrame, label: str, key: str) -> DataFrame:
    sized = with_group_stats(df, [label], {"__n": F.count(F.lit(1))})
    return hash_ranks(sized, digest(F.col(key)), "__rank", by=[label], tie=key)


def upsample(df: DataFrame, label: str, key: str) -> DataFrame:
    """Every class as large as the largest one.

    All rows stay; the missing ones are further copies, spread evenly in hash order of the key.
    ``copy`` is 0 for the row itself.
    """
    ranked = with_group_stats(_ranked_with_sizes(df, label, key), [], {"__top": F.max("__n")})
    extra = F.pmod(F.col("__top"), F.col("__n"))
    copies = F.floor(F.col("__top") / F.col("__n")) + (F.col("__rank") <= extra).cast("int")
    return repeat_rows(ranked, copies, "copy").select(*df.columns, "copy")


def downsample(df: DataFrame, label: str, key: str) -> DataFrame:
    """Every class as small as the smallest one, drawn without replacement in hash order."""
    ranked = with_group_stats(_ranked_with_sizes(df, label, key), [], {"__low": F.min("__n")})
    return ranked.where(F.col("__rank") <= F.col("__low")).select(*df.columns)


def move_class(df: DataFrame, count: str, *, above: int = 2, name: str = "class") -> DataFrame:
    """Turn a count of moves into a class."""
    return df.withColumn(name, F.when(F.col(count) > above, "Move").otherwise("NoMove"))


def smote(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    *,
    minority: object,
    copies: int = fixed.SMOTE_COPIES,
    neighbours: int = fixed.SMOTE_NEIGHBOURS,
    majority_per_copy: int = fixed.SMOTE_MAJORITY_PER_COPY,
    seed: int = 0,
) -> DataFrame:
    """Minority rows, synthetic rows between them, and majority rows drawn with replacement.

    A synthetic row lies on the line from a minority row to one of its nearest minority
    neighbours. Equal rows are handled once with their number, so many copies of one row cost
    nothing; they are each other's nearest neighbours, as they should be. Draws come from hashes
    and are the same in every run. Output: the features, the label and ``source``. The rows are
    read several times, so pass a staged table.
    """
    features = list(features)
    rare = df.where(F.col(label) == minority)
    common = df.where(F.col(label) != minority)
    vector = F.array(*[F.col(c).cast("double") for c in features])
    distinct = rare.groupBy(vector.alias("vec")).agg(F.count(F.lit(1)).alias("n"))
    near = nearest_vectors(distinct, neighbours)

    own = F.array_repeat(F.col("vec"), F.least(F.col("n") - 1, F.lit(neighbours)).cast("int"))
    others = F.flatten(
        F.transform("near", lambda s: F.array_repeat(s["vec"], F.least(s["n"], F.lit(neighbours)).cast("int")))
    )
    pool = F.slice(F.concat(own, others), 1, neighbours)
    listed = near.select("vec", "n", pool.alias("pool"), digest(F.array_join("vec", ",")).alias("id"))
    listed = stage(listed.where(F.size("pool") > 0), "neighbours")
    drawn = repeat_rows(listed, F.col("n") * copies, "i", spread=True)
    pick = F.floor(unit_hash(F.col("id"), F.col("i"), f"n{seed}") * F.size("pool")).cast("int")
    gap = unit_hash(F.col("id"), F.col("i"), f"g{seed}")
    mixed = F.zip_with(
        "vec", F.get("pool", pick), lambda a, b: a + (b - a) * F.col("gap")
    )
    made = drawn.withColumn("gap", gap).select(mixed.alias("new"), "id", "i")
    synthetic = made.select(
        *[F.col("new")[i].alias(c) for i, c in enumerate(features)],
        F.lit(minority).alias(label),
        F.lit("synthetic").alias("source"),
    )

    size = F.lit(common.count())
    draws = repeat_rows(
        listed.select("id", "n"), F.col("n") * copies * majority_per_copy, "i", spread=True
    ).select((F.floor(unit_hash(F.col("id"), F.col("i"), f"m{seed}") * size) + 1).alias("__rank"))
    ranked = hash_ranks(common.select(key, *features, label), digest(F.col(key)), "__rank", tie=key)
    majority = draws.join(ranked, "__rank")

    plain = lambda d, source: d.select(
        *[F.col(c).cast("double").alias(c) for c in features], label, F.lit(source).alias("source")
    )
    return plain(rare, "minority").unionByName(synthetic).unionByName(plain(majority, "majority"))
