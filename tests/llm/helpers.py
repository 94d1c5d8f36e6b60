"""Small tables for the operators: nulls, empty and long texts, repeated rows, clashing extra columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeiost") for _ in range(rng.randint(2, 6))) for _ in range(n))


def odd_documents(seed=1):
    """About forty rows with every odd case, some near copies and shared passages."""
    rng = random.Random(seed)
    base, passage = prose(rng, 120), prose(rng, 14)
    rows = [(k, prose(rng, rng.randint(5, 90)), "en", f"s{k % 3}", 0) for k in range(12)]
    rows += [(20 + k, " ".join(w if rng.random() > 0.01 * k else "x" for w in base.split()), "en", "s0", 0) for k in range(8)]
    rows += [(40 + k, f"{prose(rng, 10)} {passage} {prose(rng, 10)}", "de", "s1", 0) for k in range(4)]
    rows += [(50, None, None, None, None), (51, "", "en", "s0", 0), (52, " \t\n", "en", None, 3), (53, "one two three", "en", "s2", 13), (54, "One TWO  three", "en", "s2", 14),
             (55, "é" * 40 + " ü", "fr", "s2", 42), (56, "é" * 40 + " ü", "fr", "s2", 42), (57, "a" * 30000, "en", "s1", 30000), (58, "a" * 30000 + "b", "en", "s1", 30001),
             (59, prose(rng, 3000), "en", "s0", 0), (20, base, "en", "s0", 0), (20, base, "en", "s0", 0), (None, base, "en", "s0", 0), (None, None, None, None, None)]
    return rows


def documents(spark, rows=None):
    return spark.createDataFrame(odd_documents() if rows is None else rows, DOCS)


def clashing(df):
    """The frame with columns named as operators may name theirs."""
    from pyspark.sql import functions as F

    for name in ("id", "key", "unit", "same", "bucket", "component", "src", "h", "row", "score", "kept", "vec", "grp", "label2"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit("extra"))
    return df
