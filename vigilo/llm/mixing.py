"""Mixing sources to target weights: one temperature for all shares, then budgeted block permutations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilo.llm.common import table
from vigilo.sources.tables import stage

#: Bisection steps that one pass over the shares answers, and passes: 45 halvings of the exponent.
STEPS, PASSES = 5, 9
#: Parts into which the rows of a source are dealt when they meet its limits.
SALTS = 64
#: Decimals of the exponent; weights then come out alike however the sums were added.
EXPONENT_DECIMALS = 9


def word_count(text: Column) -> Column:
    """Words between ASCII white space, of the whole text; null has none."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")).cast("long")


def _measures(shares: DataFrame, exponents: list[float], budget: float) -> dict[float, tuple[float, float]]:
    """Entropy of the weights p^x / sum and the largest number of passes over a source, for each exponent."""
    powers = shares.select("tokens", "share", F.explode(F.array(*[F.lit(x) for x in exponents])).alias("x"))
    powers = powers.select("x", "tokens", F.exp(F.col("x") * F.log("share")).alias("w"))
    sums = powers.groupBy("x").agg(F.sum("w").alias("s"), F.sum(F.col("w") * F.log("w")).alias("wl"), F.max(F.col("w") / F.col("tokens")).alias("m"))
    return {r["x"]: (math.log(r["s"]) - r["wl"] / r["s"], r["m"] / r["s"] * budget) for r in sums.collect()}


def temperature(shares: DataFrame, budget: float, *, entropy: float | None = None, most_passes: float | None = None) -> float:
    """The largest exponent in [0, 1] that meets the targets; 1 leaves the shares as they are.

    Entropy falls as the exponent grows. ``entropy`` is a share of the largest possible one: the mix has at
    least that much. ``most_passes`` limits how often a source is repeated; repetition of the smallest
    source falls as the exponent grows, so this is a lower limit, and it wins over the entropy. Each pass
    measures all midpoints that the next ``STEPS`` halvings can visit; only those sums reach the driver.
    """
    count = shares.count()
    if count < 2:
        return 1.0
    low, high, floor_low, floor_high = 0.0, 1.0, 0.0, 1.0
    wanted = None if entropy is None else entropy * math.log(count)

    def middles(a: float, b: float) -> list[float]:
        return [a + (b - a) * k / 2 ** STEPS for k in range(2 ** STEPS + 1)]

    for _ in range(PASSES):
        seen = _measures(shares, sorted({*middles(low, high), *middles(floor_low, floor_high)}), budget)
        grid = middles(low, high)
        if wanted is not None:
            a, b = 0, 2 ** STEPS
            if seen[grid[b]][0] >= wanted - 1e-12:
                a = b
            while b - a > 1:
                m = (a + b) // 2
                a, b = (m, b) if seen[grid[m]][0] >= wanted else (a, m)
            low, high = grid[a], grid[b]
        grid = middles(floor_low, floor_high)
        if most_passes is not None:
            a, b = 0, 2 ** STEPS
            if seen[grid[a]][1] <= most_passes + 1e-12:
                b = a
            while b - a > 1:
                m = (a + b) // 2
                a, b = (a, m) if seen[grid[m]][1] <= most_passes else (m, b)
            floor_low, floor_high = grid[a], grid[b]
    best = 1.0 if wanted is None else low
    if most_passes is not None:
        best = max(best if wanted is not None else 0.0, floor_high)
    return round(best, EXPONENT_DECIMALS)


def mix(
    docs: DataFrame,
    key: str,
    source: str,
    text: str,
    *,
    entropy: float | None = 0.97,
    most_passes: float | None = 2.0,
    budget: int | None = None,
    block_rows: int = 4096,
    seed: int = 0,
    carry: bool = False,
) -> DataFrame:
    """Per row of the mix: ``key``, ``source``, ``n_tokens``, ``copies`` and ``position``.

    With ``carry`` a last column ``row`` holds all columns of the row as a struct.

    Shares of the sources are counted in words of the whole texts, raised to one exponent and normalised.
    A source gets its weight times ``budget`` words (all words when None). Its rows are permuted in blocks:
    hashes put rows into blocks of about ``block_rows``, blocks in random order, rows in random order inside
    them. Whole passes repeat every row; the last pass takes rows from the front until the words are spent
    (a row is taken when the words before it leave at least half of it). ``position`` numbers the words
    before the row in its source's order. Rows without any copy are left out: they are over budget.

    Running sums are taken inside a block and over block totals, so a source with a third of all rows is
    many small windows. Rows meet the limits of their source by source and salt, then go to their blocks, and
    carry nothing but numbers on the way; what ``carry`` asks for is joined by row once positions are known. Nulls: a null source is a source of its own, a null or empty text has no words; such
    rows cost nothing and go with every whole pass, and the last pass if it reaches them. Equal keys, and
    repeated rows, are ordered by hash of their text as well and may swap only with identical rows. An empty
    table gives no rows. Without ``carry`` other columns are not read.
    """
    none = F.lit("without a source")
    name = F.col(source).cast("string")
    held = stage(docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(key).alias("k"), name.alias("name"), F.coalesce(F.concat(F.lit("s"), name), none).alias("src"), word_count(F.col(text)).alias("n"),
        F.xxhash64(F.lit(seed), F.col(key), F.coalesce(F.col(text), F.lit(""))).alias("h"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else [])), "mix")
    rows = held.select("row_id", "k", "name", "src", "n", "h")
    totals = rows.groupBy("src").agg(F.sum("n").alias("tokens"), F.count("*").alias("rows"))
    words = totals.agg(F.sum("tokens")).first()[0] or 0
    spend = float(words if budget is None else budget)
    shares = totals.where("tokens > 0").select("src", "tokens", (F.col("tokens") / F.lit(float(words or 1))).alias("share"))
    power = temperature(shares, spend, entropy=entropy, most_passes=most_passes)
    # Decimals add up to the same sum in any order.
    weight = F.exp(F.lit(power) * F.log("share")).cast("decimal(28,15)")
    norm = float(shares.agg(F.sum(weight)).first()[0] or 1)
    passes = weight.cast("double") / norm * spend / F.col("tokens")
    parts = shares.select("src", F.floor(passes).cast("long").alias("whole"),
                          F.round((passes - F.floor(passes)) * F.col("tokens")).cast("long").alias("rest"))
    limits = totals.join(parts, "src", "left").select(
        "src", F.coalesce("whole", F.lit(1).cast("long")).alias("whole"), F.coalesce("rest", F.lit(0).cast("long")).alias("rest"),
        F.ceil(F.col("rows") / block_rows).alias("blocks"))

    salted = limits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64(F.lit("salt"), "h"), F.lit(SALTS)).cast("int")).join(salted, ["src", "salt"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "h"), F.col("blocks")))
    blocks = dealt.groupBy("src", "block").agg(F.sum("n").alias("held"))
    before = Window.partitionBy("src").orderBy(F.xxhash64(F.lit(seed), "src", "block"), "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("src", "block", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("src", "block").orderBy("h", "k").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inner", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(starts, ["src", "block"])
    at = F.col("start") + F.col("inner")
    last = (F.col("rest") > 0) & (2 * at + F.col("n") <= 2 * F.col("rest"))
    mixed = placed.select(
        "row_id", F.col("k").alias(key), F.col("name").alias(source), F.col("n").alias("n_tokens"),
        (F.col("whole") + last.cast("long")).alias("copies"), at.alias("position")).where("copies > 0")
    if not carry:
        return mixed.drop("row_id")
    return mixed.join(held.select("row_id", "row"), "row_id").drop("row_id")


def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to 97 % of the largest entropy, no source more than twice, for as many words as there are."""
    return mix(table(spark, folder, "documents"), "doc_id", "source", "text")
