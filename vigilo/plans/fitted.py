"""Fitted classifiers as small arrays: scoring many of them in one pass, and keeping them as rows of a table."""

from __future__ import annotations

import io
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

SCORE = "p"


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def hinge_terms(x: np.ndarray, at: np.ndarray, knots: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """How far the columns ``at`` lie beyond their knots, above (side 1) or below (side -1)."""
    return np.maximum((x[:, at] - knots) * sides, 0)


def fourier_terms(x: np.ndarray, centre: np.ndarray, scale: np.ndarray, directions: np.ndarray, phases: np.ndarray) -> np.ndarray:
    """Random features whose products estimate exp(-width * squared distance of scaled rows)."""
    return np.sqrt(2 / len(phases)) * np.cos(((x - centre) / scale) @ directions + phases)


@dataclass
class Fitted:
    """One classifier over ``columns``: how its arrays become a score, and the setting it was fitted with."""

    method: str
    kind: str
    columns: list[str]
    setting: dict = field(default_factory=dict)
    arrays: dict[str, np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Score of class 1 per row; missing where a feature is."""
        fine = np.isfinite(x).all(axis=1)
        out = np.full(len(x), np.nan)
        if fine.any():
            out[fine] = getattr(self, f"_{self.kind}")(x[fine])
        return out

    def _constant(self, x):
        return np.full(len(x), float(self.arrays["value"]))

    def _linear(self, x):
        return logistic(x @ self.arrays["weights"] + self.arrays["intercept"])

    def _hinges(self, x):
        return logistic(hinge_terms(x, self.arrays["at"], self.arrays["knots"], self.arrays["sides"]) @ self.arrays["weights"] + self.arrays["intercept"])

    def _fourier(self, x):
        a = self.arrays
        return logistic(fourier_terms(x, a["centre"], a["scale"], a["directions"], a["phases"]) @ a["weights"] + a["intercept"])

    def _net(self, x):
        hidden = logistic(x @ self.arrays["inner"] + self.arrays["inner_intercept"])
        return logistic(hidden @ self.arrays["weights"] + self.arrays["intercept"])

    def _gaussian(self, x):
        a = self.arrays
        seen = [a["prior"][c] - 0.5 * (np.log(2 * np.pi * a["variance"][c]) + (x - a["mean"][c]) ** 2 / a["variance"][c]).sum(axis=1) for c in (0, 1)]
        return logistic(seen[1] - seen[0])

    def _leaves(self, x, depths: Sequence[int]):
        """Values of the nodes that each row has reached after each of the rising ``depths``, for every tree."""
        a = self.arrays
        inner = a["feature"] >= 0
        # A leaf leads to itself: no value is beyond its threshold.
        feature, threshold = np.where(inner, a["feature"], 0).astype(np.int64), np.where(inner, a["threshold"], np.inf)
        left = np.where(inner, a["left"], np.arange(len(inner)))
        deepest = int(a["depth"].max(initial=0))
        flat, starts = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
        for root in a["roots"]:
            node, reached, out = np.full(len(x), root), 0, []
            for depth in depths:
                for _ in range(min(depth, deepest) - reached):
                    beyond = flat.take(starts + feature.take(node)) > threshold.take(node)
                    node = left.take(node)
                    node += beyond
                reached = max(reached, min(depth, deepest))
                out.append(a["value"].take(node))
            yield out

    def _forests(self, x, depths: Sequence[int]):
        """Score of the forest cut off at each of the rising ``depths``."""
        totals = [np.zeros(len(x)) for _ in depths]
        for values in self._leaves(x, depths):
            for total, value in zip(totals, values, strict=True):
                total += value
        return [total / len(self.arrays["roots"]) for total in totals]

    def _forest(self, x):
        return self._forests(x, [self.setting["maxDepth"]])[0]

    def _boosted(self, x):
        return logistic(sum((v for v, in self._leaves(x, [self.setting["maxDepth"]])), np.full(len(x), float(self.arrays["start"]))))

    @property
    def feature_gain(self) -> np.ndarray:
        """Share of the impurity each column removed, per tree and then on average; trees only."""
        a = self.arrays
        ends = np.append(a["roots"][1:], len(a["feature"]))
        total = np.zeros(len(self.columns))
        for start, end in zip(a["roots"], ends, strict=True):
            inner = (a["feature"][start:end] >= 0) & (a["depth"][start:end] < self.setting["maxDepth"])
            gain = np.bincount(a["feature"][start:end][inner], a["gain"][start:end][inner], len(self.columns))
            total += gain / gain.sum() if gain.sum() > 0 else 0
        return total / total.sum() if total.sum() > 0 else total

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the score as ``p``."""
        return with_scores(df, {SCORE: self})

    def to_row(self) -> tuple[str, str, list[str], str, bytes]:
        buffer = io.BytesIO()
        np.savez(buffer, **self.arrays)
        return self.method, self.kind, self.columns, json.dumps(self.setting), buffer.getvalue()

    @classmethod
    def from_row(cls, method: str, kind: str, columns: Sequence[str], setting: str, arrays: bytes) -> Fitted:
        with np.load(io.BytesIO(bytes(arrays)), allow_pickle=False) as found:
            return cls(method, kind, list(columns), json.loads(setting), {k: found[k] for k in found.files})


def score_settings(fits: Sequence[Fitted], x: np.ndarray) -> list[np.ndarray]:
    """Scores of one method at several settings; depths of one forest are read off on one way down its trees."""
    depths = [f.setting.get("maxDepth") for f in fits]
    if len(fits) > 1 and all(f.kind == "forest" and f.arrays is fits[0].arrays for f in fits) and depths == sorted(depths):
        fine = np.isfinite(x).all(axis=1)
        out = [np.full(len(x), np.nan) for _ in fits]
        if fine.any():
            for one, found in zip(out, fits[0]._forests(x[fine], depths), strict=True):
                one[fine] = found
        return out
    return [f.score(x) for f in fits]


#: Columns of a table of fitted classifiers.
ROW_SCHEMA = "method string, kind string, columns array<string>, setting string, arrays binary"


def numbers(batch, names: Sequence[str]) -> np.ndarray:
    """Columns of an Arrow batch as doubles; what is missing is not a number."""
    got = [batch.column(n).cast("float64").to_numpy(zero_copy_only=False) for n in names]
    return np.column_stack(got) if got else np.empty((batch.num_rows, 0))


def larger(batches, rows: int):
    """Arrow batches joined until they hold so many rows."""
    import pyarrow as pa

    waiting, count = [], 0
    for batch in batches:
        waiting.append(batch)
        count += batch.num_rows
        if count >= rows:
            yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            waiting, count = [], 0
    if count:
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


def with_columns(df: DataFrame, names: Sequence[str], columns: Sequence[str], work) -> DataFrame:
    """``df`` with double columns ``names`` that ``work`` makes of each batch and the numbers in ``columns``; missing where not a number."""
    names = list(names)
    schema = StructType([*[f for f in df.schema.fields if f.name not in names], *[StructField(n, DoubleType()) for n in names]])
    keep = [f.name for f in df.schema.fields if f.name not in names]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            made = work(batch, numbers(batch, columns)) if batch.num_rows else np.empty((0, len(names)))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keep], *[pa.array(made[:, k], from_pandas=True) for k in range(len(names))]], names=[*keep, *names])

    return df.mapInArrow(run, schema)


def long_scores(df: DataFrame, keep: Sequence[str], models: Mapping[str, Fitted]) -> DataFrame:
    """One row for each row and model that can score it: ``keep``, ``model`` and ``score``."""
    columns = list(dict.fromkeys(c for m in models.values() for c in m.columns))
    place = {n: [columns.index(c) for c in m.columns] for n, m in models.items()}
    rows = df.select(*keep, *[F.col(f"`{c}`").cast("double").alias(f"__x{k}") for k, c in enumerate(columns)])
    schema = StructType([*[rows.schema[c] for c in keep], StructField("model", StringType()), StructField("score", DoubleType())])
    titles = [f"__x{k}" for k in range(len(columns))]

    def run(batches):
        for batch in batches:
            x = numbers(batch, titles)
            for name, model in models.items():
                yield long_batch([batch.column(c) for c in keep], keep, name, model.score(x[:, place[name]]))

    return rows.mapInArrow(run, schema)


def long_batch(kept: Sequence, names: Sequence[str], model: str, score: np.ndarray):
    """A batch of kept columns with one model's scores, without rows that it cannot score."""
    import pyarrow as pa

    fine = pa.array(np.isfinite(score))
    whole = pa.RecordBatch.from_arrays([*kept, pa.array([model] * len(score), pa.string()), pa.array(score)], names=[*names, "model", "score"])
    return whole.filter(fine)


def with_scores(df: DataFrame, models: Mapping[str, Fitted]) -> DataFrame:
    """``df`` with the score of every model under its name, in one pass over the rows."""
    if not models:
        return df
    columns = list(dict.fromkeys(c for m in models.values() for c in m.columns))
    place = {n: [columns.index(c) for c in m.columns] for n, m in models.items()}
    return with_columns(df, list(models), columns, lambda _, x: np.column_stack([m.score(x[:, place[n]]) for n, m in models.items()]))
