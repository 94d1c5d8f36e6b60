"""Host and path rules for URLs: a blocked Bloom filter before an exact hash join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.llm.common import table

#: Rules of the registered query (fixed values): host and path as one string, verdict.
PAGE_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
BLOCK_BITS = 512
PROBES = 6


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", 2)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def _positions(key: Column) -> Column:
    """Bit positions of a key inside its block: double hashing over 512 bits."""
    first, step = F.xxhash64(key, F.lit(1)), F.xxhash64(key, F.lit(2)).bitwiseOR(F.lit(1))
    return F.array(*[F.pmod(first + F.lit(k) * F.pmod(step, F.lit(BLOCK_BITS)), F.lit(BLOCK_BITS)) for k in range(PROBES)])


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(blocks))


def blocked_bloom(rules: DataFrame, key: str, blocks: int) -> DataFrame:
    """``block`` and ``words``, eight longs of 64 bits each: at most ``blocks`` rows of 64 bytes."""
    bits = rules.select(_block(F.col(key), blocks).alias("block"), F.explode(_positions(F.col(key))).alias("bit")).distinct()
    words = [F.bit_or(F.when(F.floor(F.col("bit") / 64) == k, F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int")))
                      .otherwise(F.lit(0).cast("long"))).alias(f"w{k}") for k in range(BLOCK_BITS // 64)]
    return bits.groupBy("block").agg(*words).select("block", F.array(*[f"w{k}" for k in range(BLOCK_BITS // 64)]).alias("words"))


def url_verdicts(
    pages: DataFrame,
    rules: DataFrame,
    key: str,
    url: str,
    *,
    default: str = "allow",
    blocks: int = 1024,
) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule`` and ``verdict`` of every row.

    ``rules`` has ``rule`` (host, then path from its first ``/``) and ``verdict``. A rule fits its host
    and every subdomain when the path of the URL starts with the rule's path; the longest rule wins, and
    ``default`` holds where none fits. Candidates of a URL are its host suffixes with the path prefixes
    whose length occurs among the rules. Those that pass a blocked Bloom filter of the rules (``blocks``
    rows of 64 bytes, broadcast: its size does not depend on the rules) meet the rules in an exact join,
    which removes the false positives. More rules than the blocks hold well only raise their number.

    Nulls: a null URL, or one without ``://``, has empty host and path and gets the default; a null key
    is kept. Rules that are null or repeated count once (the smallest verdict). An empty table of either
    kind gives no row, or only defaults. Rows are told apart by position, so repeated rows stay; other
    columns of ``pages`` are not read.
    """
    host, path = url_parts(F.col(url))
    rows = pages.select(F.col(key).alias("k"), host.alias("host"), path.alias("path"))
    listed = rules.where("rule is not null").groupBy("rule").agg(F.min("verdict").alias("verdict"))
    bits = blocked_bloom(listed, "rule", blocks)
    cut = F.when(F.instr("rule", "/") == 0, F.length("rule")).otherwise(F.instr("rule", "/") - 1)
    # Distinct lengths of rule paths: at most as many numbers as the longest URL has characters.
    sizes = sorted(row[0] for row in listed.select((F.length("rule") - cut).cast("int")).distinct().collect())

    names = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(names)), lambda i: F.array_join(F.slice(names, i, F.size(names)), "."))
    lengths = F.array(*[F.lit(n) for n in sizes]) if sizes else F.array().cast("array<int>")
    fitting = F.filter(lengths, lambda n: n <= F.length("path"))
    heads = F.transform(fitting, lambda n: F.substr(F.col("path"), F.lit(1), n))
    keys = F.flatten(F.transform(suffixes, lambda h: F.transform(heads, lambda p: F.concat(h, p))))
    # The same address is judged once, however many pages name it.
    places = rows.where("host != ''").select("host", "path").distinct()
    probes = places.select("host", "path", F.explode(F.array_distinct(keys)).alias("rule"))
    probes = probes.withColumn("block", _block(F.col("rule"), blocks))
    set_bits = F.forall(_positions(F.col("rule")), lambda b: F.call_function(
        "getbit", F.element_at(F.col("words"), (F.floor(b / 64) + 1).cast("int")), (b % 64).cast("int")) == 1)
    possible = probes.join(F.broadcast(bits), "block").where(set_bits).select("host", "path", "rule")
    best = possible.join(listed, "rule").groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("n"), F.col("rule"), F.col("verdict"))).alias("best"))
    return rows.join(best, ["host", "path"], "left").select(
        F.col("k").alias(key), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(list(PAGE_RULES), "rule string, verdict string")
    return url_verdicts(table(spark, folder, "pages"), rules, "page_id", "url")


_RULE_ROWS = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in PAGE_RULES)
OP9_SQL = f"""
WITH r(rule, verdict) AS (VALUES {_RULE_ROWS}),
cut AS (SELECT rule, verdict, split_part(rule, '/', 1) AS h, substr(rule, strpos(rule, '/')) AS p FROM r),
u AS (
  SELECT page_id, row_number() OVER () AS i,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
  FROM pages),
m AS (
  SELECT u.i, max_by(cut.rule, length(cut.rule)) AS rule, max_by(cut.verdict, length(cut.rule)) AS verdict
  FROM u JOIN cut ON (u.host = cut.h OR ends_with(u.host, '.' || cut.h)) AND starts_with(u.path, cut.p)
  GROUP BY u.i)
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM u LEFT JOIN m ON u.i = m.i
"""
