"""A corpus pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

Columns of ``documents`` beyond the known ones pass through unchanged.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.llm import bpe, minhash_dedup, mixing, suffix_dedup, toxicity
from vigilo.llm.common import held_out, table
from vigilo.sources.tables import discard, stage, staged_paths

_LEFT: list[str] = []


def _tidy(step):
    """A stage that first deletes what the stage before it staged: that one's result is in its own Parquet by now."""

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _LEFT)
        _LEFT.clear()
        with staged_paths() as paths:
            out = step(spark, docs, sf_dir)
        _LEFT.extend(paths)
        return out

    return run_step


#: Score from which a document counts as toxic.
REJECT = 0.3


@_tidy
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones outside the held-out fold, does not reject; all where no label can be used."""
    weights = toxicity.fit(docs, "doc_id", "text", table(spark, sf_dir, "labels"), "doc_id", "toxic", ~held_out("doc_id", 4))
    scored = toxicity.with_score(docs, "text", weights, "score of this stage")
    return scored.where(F.col("score of this stage") < REJECT).drop("score of this stage")


@_tidy
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group of near copies; rows without an id stay.

    An id is one document: rows that share it stay or go together, whatever their texts.
    """
    found = minhash_dedup.near_duplicates(docs, "doc_id", "text")
    gone = found.where("not kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])


@_tidy
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that 50-byte strings of earlier documents cover; ``n_chars`` is counted anew."""
    carry = [c for c in docs.columns if c != "text"]
    done = suffix_dedup.remove_repeats(docs, "doc_id", "text", carry)
    place = {c: F.col(f"carried{k}") for k, c in enumerate(carry)} | {"text": F.col("text")}
    if "n_chars" in place:
        place["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return done.select(*[place[c].alias(c) for c in docs.columns])


@_tidy
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to 97 % of the largest entropy, no row more than twice; repeated rows come out repeated."""
    mixed = mixing.mix(docs, "doc_id", "source", "text", carry=True)
    copies = mixed.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return copies.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


@_tidy
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the bytes they decode to."""
    ranks = bpe.rank_file(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode_and_decode(docs, "doc_id", "text", ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("bpe", encode),
]
#: A classifier and hash sketches have no SQL; tests compare run() with the stages worked out by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
