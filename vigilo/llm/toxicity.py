"""Toxicity: a logistic classifier whose scores may not move when identity terms are swapped."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from vigilo.llm.common import held_out, table
from vigilo.sources.tables import stage

#: Terms that name people neutrally (fixed values); a term is swapped with the others of its group.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girl", "boy"), ("girls", "boys"), ("female", "male"), ("mother", "father"), ("she", "he"),
    ("gay", "straight", "lesbian", "bisexual", "queer", "heterosexual"), ("transgender", "cisgender", "nonbinary"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist"), ("christians", "muslims", "jews", "hindus", "buddhists"),
    ("black", "white", "asian", "latino", "african", "european", "arab"), ("american", "mexican", "chinese", "indian", "german", "french"),
    ("young", "old"), ("deaf", "blind", "disabled"), ("immigrant", "refugee", "native"),
    ("frauen", "männer"), ("frau", "mann"), ("mujeres", "hombres"), ("mujer", "hombre"), ("femmes", "hommes"), ("femme", "homme"),
)
WORD = re.compile(r"[^\W\d_]+")
BIAS = ""
#: Bias where no label could be used: nothing is rejected then.
NOTHING_LEARNED = -20.0


@dataclass(frozen=True)
class Settings:
    """Bounds and strengths of the fit. ``sample`` is the expected largest number of labelled rows used."""

    sample: int = 16_384
    features: int = 4_096
    least_docs: int = 3
    least_far: float = 3.0
    ridge: float = 1.0
    counterfactual: float = 1.0
    rounds: int = 300
    groups: tuple = field(default=IDENTITY_TERMS)


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def features_of(words: set[str]) -> set[str]:
    """The words, and with a star the first five and six letters of longer ones, which inflected forms share."""
    return words | {w[:n] + "*" for w in words for n in (5, 6) if len(w) > n}


def swapped(words: set[str], groups) -> set[str]:
    """The words with every identity term replaced by the next one of its group."""
    after = {term: group[(k + 1) % len(group)] for group in groups for k, term in enumerate(group)}
    return {after.get(w, w) for w in words}


def _word_lists(batches):
    import pyarrow as pa

    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            lists = [sorted(words_of(t)) for t in batch.column(2).to_pylist()]
            more = [sorted(features_of(set(w))) for w in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(x, pa.list_(pa.string())) for x in (lists, more))],
                                             names=["id", "y", "words", "features"])


def fit_weights(y: np.ndarray, rows: list[np.ndarray], moves: list[tuple[np.ndarray, np.ndarray]], size: int, s: Settings) -> np.ndarray:
    """Weights (the last one is the bias) of the regularised logistic loss, by accelerated gradient steps.

    ``rows`` are the feature numbers of each text, ``moves`` those a swap removes and adds. The loss is the
    mean log loss, ``ridge`` / n times half the squared weights, and ``counterfactual`` times half the mean
    squared change of the score's logit under the swap.
    """
    n = len(y)
    at, who = np.concatenate([*rows, np.empty(0, int)]).astype(int), np.repeat(np.arange(n), [len(r) for r in rows])
    gone = np.concatenate([*[m[0] for m in moves], np.empty(0, int)]).astype(int)
    come = np.concatenate([*[m[1] for m in moves], np.empty(0, int)]).astype(int)
    m_at, m_sign = np.concatenate([gone, come]), np.concatenate([-np.ones(len(gone)), np.ones(len(come))])
    m_who = np.concatenate([np.repeat(np.arange(len(moves)), [len(m[0]) for m in moves]), np.repeat(np.arange(len(moves)), [len(m[1]) for m in moves])]).astype(int)
    weight, ahead, momentum = np.zeros(size + 1), np.zeros(size + 1), 1.0
    weight[-1] = ahead[-1] = math.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    share = np.bincount(at, minlength=size) / n
    # A diagonal bound of the curvature: texts hold few features that tell, so steps per feature are safe at this size.
    reach = max((len(r) for r in rows), default=1)
    curve = np.append(0.25 * share * min(reach, 8) + s.ridge / n + s.counterfactual * np.bincount(m_at, minlength=size) * 4 / max(len(moves), 1), 0.25 * min(reach, 8) + 1e-6)
    for _ in range(s.rounds):
        logit = np.bincount(who, ahead[at], n) + ahead[-1]
        miss = 1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y
        slope = np.append(np.bincount(at, miss[who], size) / n + s.ridge / n * ahead[:-1], miss.mean())
        if len(moves):
            change = np.bincount(m_who, m_sign * ahead[m_at], len(moves))
            slope[:-1] += s.counterfactual / len(moves) * np.bincount(m_at, m_sign * change[m_who], size)
        new, next_momentum = ahead - slope / curve, (1 + math.sqrt(1 + 4 * momentum * momentum)) / 2
        if ((ahead - new) * (new - weight)).sum() > 0:
            next_momentum, momentum = 1.0, 1.0
        ahead = new + (momentum - 1) / next_momentum * (new - weight)
        weight, momentum = new, next_momentum
    return weight


def fit(docs: DataFrame, key: str, text: str, labels: DataFrame, label_key: str, label: str, allowed: Column, s: Settings = Settings()) -> dict[str, float]:
    """Weights by word, and of the bias under the empty word.

    Learns from rows that ``allowed`` admits (a condition on ``labels``) whose label is 0 or 1; a hash of the
    id takes about ``sample`` of them at most. Words that at least ``least_docs`` of these texts hold are
    ranked by how many standard deviations their number of texts with label 1 is from the expected one;
    those ``least_far`` or more away are kept, up to ``features``, and identity terms always. The fit itself is one task over that bounded sample.
    Without any such row, or any text of one, there is only a bias so low that every text scores nearly 0.
    """
    known = labels.where(allowed & F.col(label).isin(0, 1)).groupBy(F.col(label_key).alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    known = known.where("id is not null")
    count = known.count()
    if not count:
        return {BIAS: NOTHING_LEARNED}
    share = min(1.0, s.sample / count)
    chosen = known.where(F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1_000_000)) < share * 1_000_000)
    # About ``sample`` ids of 12 bytes: a bound that does not grow with the tables.
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id").select("id", "y", "text")
    rows = stage(texts.mapInArrow(_word_lists, "id long, y int, words array<string>, features array<string>"), "labelled")
    base = rows.agg(F.count("*").alias("n"), F.sum("y").alias("p")).first()
    if not base.n:
        return {BIAS: NOTHING_LEARNED}
    rate = (base.p + 0.5) / (base.n + 1)
    seen = rows.select("y", F.explode("features").alias("word")).groupBy("word").agg(F.count("*").alias("n"), F.sum("y").alias("p"))
    far = F.abs(F.col("p") - F.col("n") * rate) / F.sqrt(F.col("n") * (rate * (1 - rate)) + 1)
    terms = sorted({t for g in s.groups for t in g})
    best = seen.where((F.col("n") >= s.least_docs) & (far >= s.least_far) & ~F.col("word").isin(terms)).orderBy(far.desc(), "word").limit(s.features)
    vocabulary = terms + sorted(r[0] for r in best.select("word").collect())
    number = {w: k for k, w in enumerate(vocabulary)}

    def number_words(batches):
        import pyarrow as pa

        def numbers(words):
            return sorted(number[w] for w in words if w in number)

        for batch in batches:
            index, gone, come = [], [], []
            for words in map(set, batch.column(2).to_pylist()):
                before = features_of(words)
                index.append(numbers(before))
                after = before if words.isdisjoint(terms) else features_of(swapped(words, s.groups))
                gone.append(numbers(before - after))
                come.append(numbers(after - before))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(x, pa.list_(pa.int32())) for x in (index, gone, come))],
                                             names=["id", "y", "index", "gone", "come"])

    def train(part):
        import pyarrow as pa

        part = part.sort_by([("id", "ascending"), ("y", "ascending")])
        index, gone, come = ([np.array(x, dtype=np.int32) for x in part.column(c).to_pylist()] for c in ("index", "gone", "come"))
        moves = [(a, b) for a, b in zip(gone, come, strict=True) if len(a) or len(b)]
        got = fit_weights(np.asarray(part.column("y"), dtype=float), index, moves, len(vocabulary), s)
        return pa.table({"word": pa.array([*vocabulary, BIAS]), "weight": pa.array(got)})

    # Only numbers of kept features reach the one task that fits.
    numbered = rows.select("id", "y", "words").mapInArrow(number_words, "id long, y int, index array<int>, gone array<int>, come array<int>")
    learned = numbered.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(train, "word string, weight double")
    return {r.word: r.weight for r in learned.collect()}


def with_score(docs: DataFrame, text: str, weights: dict[str, float], column: str = "score") -> DataFrame:
    """``docs`` with a last column ``column``: the score from 0 to 1 of every whole text.

    A null or empty text scores what the bias says. Repeated rows and null keys stay, all columns pass
    through. ``weights`` holds at most the features of the fit.
    """
    at = docs.columns.index(text)

    def run(batches):
        import pyarrow as pa

        bias = weights.get(BIAS, 0.0)
        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch, out = whole.slice(first, 256), []
                for value in batch.column(at).to_pylist():
                    logit = bias + math.fsum(weights[w] for w in features_of(words_of(value)) & weights.keys())
                    out.append(1 / (1 + math.exp(-max(-40.0, min(40.0, logit)))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names=[*batch.schema.names, column])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(column, DoubleType())]))


def score(docs: DataFrame, key: str, text: str, weights: dict[str, float]) -> DataFrame:
    """``key`` and ``score`` of every row; no other column is read."""
    return with_score(docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias("text")), "text", weights).select(key, "score")


def document_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    weights = fit(docs, "doc_id", "text", labels, "doc_id", "toxic", ~held_out("doc_id", 4))
    return score(docs, "doc_id", "text", weights)


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = document_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select("doc_id", held_out("doc_id", 4).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
