"""Quality: a convolutional network over the bytes of whole texts, written in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from vigilo.llm.common import held_out, table, text_bytes
from vigilo.sources.tables import stage

#: Bytes between two windows, and the steps a window is long.
STEP, SPAN = 4, 3
#: Bytes of one chunk; a longer text is several chunks that overlap, so that every window lies in one whole.
CHUNK = 1 << 18
#: Logit where no label could be used: nothing counts as bad then.
NOTHING_LEARNED = 20.0


@dataclass(frozen=True)
class Settings:
    """Bounds of the fit: ``sample`` is the expected largest number of labelled rows used."""

    sample: int = 4_096
    filters: int = 32
    width: int = 8
    steps: int = 1_500
    batch: int = 32
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 11


def chunks_of(text: bytes, size: int = CHUNK):
    """Arrays of bytes that hold every window of the text once or twice; zeros fill up the last one.

    A window begins at each ``STEP``-th byte of the text (one at least) and is ``STEP`` times ``SPAN`` bytes long.
    """
    reach = STEP * (SPAN - 1)
    size -= size % STEP
    for at in range(0, max(len(text), 1), size):
        part = text[at:at + size + reach]
        whole = max(-(-min(len(part), size) // STEP), 1) * STEP + reach
        yield at, np.frombuffer(part + bytes(whole - len(part)), dtype=np.uint8) if len(part) < whole else np.frombuffer(part[:whole], dtype=np.uint8)


class Network:
    """Embedded bytes, filters over windows, the largest answer of each filter, one probability."""

    def __init__(self, embed, kernel, offset, weight, bias):
        self.embed, self.kernel, self.offset, self.weight, self.bias = embed, kernel, offset, weight, float(bias)

    @classmethod
    def fresh(cls, s: Settings, rate: float) -> Network:
        rng = np.random.default_rng(s.seed)
        embed = rng.normal(0, 0.5, (256, s.width)).astype(np.float32)
        kernel = rng.normal(0, 1 / np.sqrt(STEP * SPAN * s.width), (STEP * SPAN * s.width, s.filters)).astype(np.float32)
        weight = rng.normal(0, 0.3, s.filters).astype(np.float32)
        return cls(embed, kernel, np.zeros(s.filters, np.float32), weight, np.log(rate / (1 - rate)))

    def answers(self, raw: np.ndarray) -> np.ndarray:
        """Answer of every filter at every window of a chunk."""
        filters, width = self.kernel.shape[1], self.embed.shape[1]
        # One product per step: a window is the sum of its steps' products, so no byte is embedded twice.
        steps = self.embed[raw].reshape(-1, STEP * width)
        parts = steps @ self.kernel.reshape(SPAN, STEP * width, filters).transpose(1, 0, 2).reshape(STEP * width, SPAN * filters)
        n = len(steps) - SPAN + 1
        out = parts[:n, :filters].copy()
        for k in range(1, SPAN):
            out += parts[k:n + k, k * filters:(k + 1) * filters]
        return out

    def pooled(self, text: bytes) -> np.ndarray:
        best = None
        for _, raw in chunks_of(text):
            top = self.answers(raw).max(axis=0)
            best = top if best is None else np.maximum(best, top)
        return best

    def pooled_with_windows(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Largest answer of each filter and the bytes of the window that gave it."""
        best = windows = None
        for _, raw in chunks_of(text):
            answers = self.answers(raw)
            at = answers.argmax(axis=0)
            top = answers[at, np.arange(len(at))]
            seen = raw[at[:, None] * STEP + np.arange(STEP * SPAN)]
            if best is None:
                best, windows = top, seen
            else:
                windows = np.where((top > best)[:, None], seen, windows)
                best = np.maximum(best, top)
        return best, windows

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.offset, 0).astype(np.float64) @ self.weight.astype(np.float64) + self.bias

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        logit = self.logits(np.stack([self.pooled(t) for t in texts]))
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))

    def slopes(self, texts: list[bytes], y: np.ndarray) -> list[np.ndarray]:
        """Gradient of the mean log loss; it reaches a filter through its largest window only."""
        found = [self.pooled_with_windows(t) for t in texts]
        pooled, windows = np.stack([f[0] for f in found]), np.stack([f[1] for f in found])
        miss = (1 / (1 + np.exp(-np.clip(self.logits(pooled), -40, 40))) - y).astype(np.float32) / len(y)
        open_ = pooled + self.offset > 0
        down = miss[:, None] * self.weight * open_
        seen = self.embed[windows]
        kernel = np.einsum("tf,tfk->kf", down, seen.reshape(*windows.shape[:2], -1))
        back = down[:, :, None, None] * self.kernel.T.reshape(1, -1, STEP * SPAN, self.embed.shape[1])
        embed = np.zeros_like(self.embed)
        np.add.at(embed, windows.reshape(-1), back.reshape(-1, self.embed.shape[1]))
        return [embed, kernel, down.sum(axis=0), (miss[:, None] * np.maximum(pooled + self.offset, 0)).sum(axis=0), np.array([miss.sum()])]

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.kernel, self.offset, self.weight, np.array([self.bias])]

    def to_bytes(self) -> bytes:
        return b"".join(np.ascontiguousarray(p, dtype=np.float32).tobytes() for p in self.parts())

    @classmethod
    def from_bytes(cls, data: bytes, s: Settings) -> Network:
        shapes = [(256, s.width), (STEP * SPAN * s.width, s.filters), (s.filters,), (s.filters,), (1,)]
        flat, out = np.frombuffer(data, dtype=np.float32), []
        for shape in shapes:
            size = int(np.prod(shape))
            out.append(flat[:size].reshape(shape).copy())
            flat = flat[size:]
        return cls(*out[:4], out[4][0])


def train(texts: list[bytes], y: np.ndarray, s: Settings) -> Network:
    """A network fitted by ``steps`` moment-scaled gradient steps over shuffled batches of whole texts."""
    net = Network.fresh(s, (y.sum() + 0.5) / (len(y) + 1))
    rng, order = np.random.default_rng(s.seed + 1), np.empty(0, int)
    first, second = ([np.zeros_like(p, dtype=np.float64) for p in net.parts()] for _ in range(2))
    for step in range(1, s.steps + 1):
        while len(order) < s.batch:
            order = np.concatenate([order, rng.permutation(len(texts))])
        now, order = order[:s.batch], order[s.batch:]
        slopes = net.slopes([texts[k] for k in now], y[now])
        new, rate = [], s.rate * (1 - step / (s.steps + 1))
        for k, (part, slope) in enumerate(zip(net.parts(), slopes, strict=True)):
            slope = slope + s.decay * part * (k in (1, 3))
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope * slope
            move = first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
            new.append((part - rate * move).astype(np.float32))
        net = Network(*new[:4], new[4][0])
    return net


def fit(docs: DataFrame, key: str, text: str, labels: DataFrame, label_key: str, label: str, allowed: Column, s: Settings = Settings()) -> Network | None:
    """The network, learned from rows that ``allowed`` admits (a condition on ``labels``) whose label is 0 or 1.

    A hash of the id takes about ``sample`` of them at most, so the one task that fits gets a bounded number of
    texts, each whole. An id labelled twice counts as its larger label; rows without an id are left out. None
    where no such row has a text.
    """
    known = labels.where(allowed & F.col(label).isin(0, 1)).groupBy(F.col(label_key).alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    known = known.where("id is not null")
    share = min(1.0, s.sample / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64(F.lit("quality"), "id"), F.lit(1_000_000)) < share * 1_000_000)
    # About ``sample`` ids of 12 bytes: a bound that does not grow with the tables.
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id").select("id", "y", "text")
    rows = stage(texts, "labelled")

    def run(part):
        import pyarrow as pa

        part = part.sort_by([("id", "ascending"), ("y", "ascending"), ("text", "ascending")])
        net = train(text_bytes(part.column("text").combine_chunks()), np.asarray(part.column("y"), dtype=np.float64), s)
        return pa.table({"net": pa.array([net.to_bytes()], pa.binary())})

    found = rows.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(run, "net binary").collect()
    return Network.from_bytes(bytes(found[0][0]), s) if found else None


def with_score(docs: DataFrame, text: str, net: Network | None, column: str = "score") -> DataFrame:
    """``docs`` with a last column ``column``: the score from 0 to 1 of every whole text.

    A null or empty text is one window of zeros. Repeated rows and null keys stay, all columns pass through.
    Without a network (None) every text scores nearly 1.
    """
    at = docs.columns.index(text)
    base = 1 / (1 + np.exp(-NOTHING_LEARNED))

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for first in range(0, whole.num_rows, 256):
                batch = whole.slice(first, 256)
                out = np.full(batch.num_rows, base) if net is None else net.score(text_bytes(batch.column(at)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names=[*batch.schema.names, column])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(column, DoubleType())]))


def op11_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, out = table(spark, folder, "documents"), held_out("doc_id", 5, 0)
    net = fit(docs, "doc_id", "text", table(spark, folder, "labels"), "doc_id", "quality", ~held_out("doc_id", 5, 0))
    scored = with_score(docs.select("doc_id", "text"), "text", net).drop("text")
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
