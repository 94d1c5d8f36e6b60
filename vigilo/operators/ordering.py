"""Running sums, row numbers and quantiles over a whole table.

An ordered window without partitions would pull every row into one task. Here the ordered column
is cut into buckets first; each bucket is summed on its own and receives the total of all lower
buckets, of which there are only as many as buckets.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilo.functions.hashing import leading_int
from vigilo.operators.groups import join_groups
from vigilo.sources.tables import stage

_BUCKET = "__bucket"


def bucket_count(df: DataFrame) -> int:
    """Buckets needed so that each is one shuffle partition's share of the rows."""
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def with_value_buckets(df: DataFrame, order: str) -> DataFrame:
    """Add an order-preserving bucket of a numeric column.

    The cut points are approximate quantiles, a quarter of a bucket exact, fetched once so that every
    later use of the bucket agrees; only they reach the driver.
    """
    n = bucket_count(df)
    cuts = df.approxQuantile(order, [i / n for i in range(1, n)], 1 / (4 * n))
    inner = sorted({float(c) for c in cuts})
    splits = [-float("inf"), *inner, float("inf")]
    if len(splits) < 3:
        return df.withColumn(_BUCKET, F.lit(0.0))
    value = f"__{order}"
    bucketed = Bucketizer(splits=splits, inputCol=value, outputCol=_BUCKET, handleInvalid="keep")
    return bucketed.transform(df.withColumn(value, F.col(order).cast("double"))).drop(value)


def with_hash_buckets(df: DataFrame, hash_int: Column) -> DataFrame:
    """Add an order-preserving bucket of a uniform 32-bit hash; needs no look at the data."""
    return df.withColumn(_BUCKET, F.floor(hash_int * F.lit(bucket_count(df)) / F.lit(4294967296)))


def prefix_sums(
    bucketed: DataFrame,
    order: str | Sequence[str],
    sums: Mapping[str, str],
    *,
    by: Sequence[str] = (),
    totals: Mapping[str, str] | None = None,
    previous: str | None = None,
) -> DataFrame:
    """Inclusive running sums in the order of ``order`` within ``by``.

    ``bucketed`` comes from one of the ``with_*_buckets`` functions. ``sums`` maps an input column
    to the name of its running sum, ``totals`` to the name of its sum over the group. ``previous``
    names a column that receives the next lower value of the (single) order column.

    The rows are shuffled once, by group and bucket; the sums below each bucket join them there.
    """
    by, totals = list(by), dict(totals or {})
    order = [order] if isinstance(order, str) else list(order)
    inside = Window.partitionBy(*by, _BUCKET).orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*(by or [F.lit(0)]))
    lower = whole.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = bucketed.groupBy(*by, _BUCKET).agg(
        *[F.sum(c).alias(f"__t_{c}") for c in sums],
        *([F.max(order[0]).alias("__top")] if previous else []),
    )
    offsets = per_bucket.select(
        *by,
        _BUCKET,
        *[F.coalesce(F.sum(f"__t_{c}").over(lower), F.lit(0)).alias(f"__o_{c}") for c in sums],
        *[F.sum(f"__t_{c}").over(whole).alias(name) for c, name in totals.items()],
        *([F.max("__top").over(lower).alias("__below")] if previous else []),
    )
    left = bucketed.select(
        "*",
        *[F.sum(c).over(running).alias(f"__r_{c}") for c in sums],
        *([F.lag(order[0]).over(inside).alias("__lag")] if previous else []),
    )
    return join_groups(left, offsets, [*by, _BUCKET]).select(
        *[c for c in bucketed.columns if c != _BUCKET],
        *[(F.col(f"__r_{c}") + F.col(f"__o_{c}")).alias(name) for c, name in sums.items()],
        *totals.values(),
        *([F.coalesce("__lag", "__below").alias(previous)] if previous else []),
    )


def value_counts(df: DataFrame, value: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct value, written down once; missing values leave.

    The table itself is read this one time; cut points and running sums use the counts.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    return stage(counts, "counts")


def row_numbers(df: DataFrame, key: str, name: str, *, by: Sequence[str] = ()) -> DataFrame:
    """1-based position in ascending order of a numeric ``key`` within ``by``.

    Rows of equal keys follow each other in the order of a hash of the whole row; missing keys come first, NaN last.
    Rows are shuffled once, by group and bucket of the key, and numbered there; a bucket's first number comes
    from the small table of bucket sizes. A key that fills several buckets has places of its own, one for each
    part of the hash, and so have missing keys.
    """
    by, n = list(by), bucket_count(df)
    value = F.col(key)
    missing = value.isNull() | F.isnan(value.cast("double"))
    gaps, cuts = df.agg(
        F.count_if(missing), F.percentile_approx(F.when(~missing, value), [i / n for i in range(1, n)], 4 * n)
    ).first()
    hot = sorted(v for v, seen in Counter(cuts or []).items() if seen > 1)
    tie = F.xxhash64(*df.columns)
    part = F.pmod(tie, F.lit(n))
    inner = sorted({float(c) for c in cuts or []})
    bucket = Bucketizer(splits=[-float("inf"), *(inner or [0.0]), float("inf")], inputCol="__key", outputCol=_BUCKET, handleInvalid="keep")
    side = sum((F.when(value > h, 2).when(value == h, 1).otherwise(0) for h in hot), F.when(F.isnan(value.cast("double")), 1).otherwise(0))
    spread = F.lit(False)
    if hot:
        spread = spread | F.coalesce(value.isin(hot), F.lit(False))
    if gaps:
        spread = spread | missing
    placed = bucket.transform(df.withColumn("__key", value.cast("double"))).drop("__key").withColumns(
        {"__side": side, "__part": F.when(spread, part).otherwise(0)})
    place = [_BUCKET, "__side", "__part"]
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(*by, *place).agg(F.count(F.lit(1)).alias("__n")).select(
        *by, *place, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    own = F.row_number().over(Window.partitionBy(*by, *place).orderBy(key, part, tie))
    return join_groups(placed.withColumn("__own", own), stage(starts, "starts"), [*by, *place]).select(
        *df.columns, (F.col("__start") + F.col("__own")).alias(name))


def hash_ranks(df: DataFrame, key: Column, name: str, *, by: Sequence[str] = (), tie: str) -> DataFrame:
    """1-based position in hash order of ``key`` (a hex digest); ``tie`` orders equal digests."""
    ones = df.withColumns({"__one": F.lit(1).cast("long"), "__digest": key})
    bucketed = with_hash_buckets(ones, leading_int(F.col("__digest")))
    return prefix_sums(bucketed, ["__digest", tie], {"__one": name}, by=by).drop("__one", "__digest")


def quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], *, by: Sequence[str] = ()
) -> DataFrame:
    """Exact linearly interpolated quantiles; one row per group, columns ``q0``, ``q1``, ...

    Works on value counts and running sums, so no task has to hold a whole column.
    """
    by = list(by)
    counts = with_value_buckets(value_counts(df, value, by=by), value)
    pos = prefix_sums(counts, value, {"n": "upto"}, by=by, totals={"n": "__total"})
    total = F.col("__total")
    aggs = []
    for i, p in enumerate(probabilities):
        at = (total - 1) * F.lit(float(p))
        for tag, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto"))
            aggs.append(F.max(F.when(here, F.col(value).cast("double"))).alias(f"__{tag}{i}"))
        aggs.append(F.max(at - F.floor(at)).alias(f"__f{i}"))
    found = pos.groupBy(*by).agg(*aggs)
    return found.select(
        *by,
        *[
            (F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * F.col(f"__f{i}")).alias(f"q{i}")
            for i in range(len(probabilities))
        ],
    )


def median_exceeds(col: Column, limit: float) -> Column:
    """Aggregate: is the exact median above ``limit``? One pass, constant memory per task."""
    value = col.cast("double")
    n = F.count(value)
    low = F.count_if(value <= limit)
    middle = (F.max(F.when(value <= limit, value)) + F.min(F.when(value > limit, value))) / 2
    return F.when(n == 0, F.lit(None)).when(low * 2 < n, F.lit(True)).when(
        low * 2 > n, F.lit(False)
    ).otherwise(middle > limit)


def repeat_rows(
    df: DataFrame, copies: Column, name: str, *, chunk: int = 4096, spread: bool = False
) -> DataFrame:
    """Each row ``copies`` times with a 0-based copy number.

    Two nested steps keep every generated array short, however many copies a row needs. With
    ``spread`` the blocks of a row are dealt out to all tasks before they are expanded, for data
    in which one row may stand for a large share of the result.
    """
    blocks = df.withColumn("__copies", copies.cast("long")).where("__copies > 0")
    blocks = blocks.withColumn(
        "__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__copies") - 1) / chunk)))
    )
    if spread:
        blocks = blocks.repartition(bucket_count(df), *blocks.columns)
    start = F.col("__block") * chunk
    stop = F.least(start + chunk, F.col("__copies")) - 1
    return blocks.withColumn(name, F.explode(F.sequence(start, stop))).drop("__copies", "__block")
