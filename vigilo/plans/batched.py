"""Every method, setting, fold, repetition and group fitted by one sequence of Spark jobs.

A problem is the rows outside one fold of one repetition, or all rows; a group (such as a grade) has problems of
its own. Rows are packed once; then each job sums, over all rows, small arrays for every fit that is not done
(see :mod:`vigilo.plans.smooth` and :mod:`vigilo.plans.trees`). The number of jobs depends on how deep trees grow and how many
steps the slowest fit takes, not on how many fits there are.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from vigilo.operators.evaluate import best_threshold
from vigilo.plans import smooth, trees
from vigilo.plans.blocks import Block, Blocks, group_column, pack, totals
from vigilo.plans.concurrent import together
from vigilo.plans.fitted import Fitted, larger, long_batch, numbers, score_settings
from vigilo.plans.methods import ALIASES, SEED, spread_values
from vigilo.plans.stages import discriminant

#: Bins of a column for trees, knots of a column for hinges, and random features of the radial machine.
BINS, KNOTS, FEATURES = 32, 3, 128
#: Rows that are scored at a time, and ranges of scores that are ordered apart.
SCORED_ROWS, RANGES = 1 << 15, 8
#: Rounds of boosted trees, and trees of a forest and of a bag.
ROUNDS, TREES, BAGS = 10, 20, 15


def settings(method: str, length: int, d: int) -> list[dict]:
    """The settings a method is tuned over; the first is the default. Some methods have one only."""
    depths = lambda low: [{"maxDepth": low + k} for k in range(length)]
    penalties = lambda name: [{name: v} for v in spread_values(0.001, 0.1, length)]
    parts = [{"components": k} for k in dict.fromkeys(min(d, 3 + i) for i in range(length))]
    wide = max(1, round(math.sqrt(length)))
    radial = [{"regParam": c, "width": w} for c in spread_values(0.0003, 0.03, -(-length // wide)) for w in (1.0, 0.4, 2.5, 0.15, 6.0)[:wide]]
    return {
        "random_forest": depths(6), "bagged_trees": depths(5), "decision_tree": depths(3), "boosted_trees": depths(2),
        "logistic": [{}], "elastic_net": penalties("regParam"), "ridge_logistic": penalties("regParam"), "linear_svm": penalties("regParam"),
        "hinge_logistic": penalties("regParam"), "radial_svm": radial[:length], "naive_bayes": [{}], "component_net": parts, "component_logistic": parts,
        "linear_discriminant": [{}], "shrunken_centroid": [{"shrink": 0.5 * (k + (length == 1))} for k in range(length)],
    }[method]


def known_method(method: str) -> str:
    name = ALIASES.get(method, method)
    settings(name, 1, 1)
    return name


@dataclass
class Fits:
    """All fits: ``models[group, method]`` per setting and problem, the last problem being all rows."""

    columns: list[str]
    label: str
    folds: list[str]
    count: int
    group: str | None
    models: dict[tuple[str, str], list[list[Fitted]]]
    elapsed: dict[tuple[str, str], float]
    best: dict[tuple[str, str], int] = field(default_factory=dict)

    @property
    def groups(self) -> list[str]:
        return sorted({g for g, _ in self.models})

    def methods(self) -> list[str]:
        return list(dict.fromkeys(m for _, m in self.models))

    def final(self, group: str = "") -> dict[str, Fitted]:
        """Per method the fit on all rows at its best setting (the first one before tuning)."""
        return {m: found[self.best.get((g, m), 0)][-1] for (g, m), found in self.models.items() if g == group}

    def held_out(self, df: DataFrame, *, keep: Sequence[str]) -> DataFrame:
        """Scores by models that never saw the row's fold, one row for each repetition.

        ``keep`` and the group come first, then the label, ``rep``, ``held_fold`` and ``p_<method>`` at the best setting.
        """
        names = [(m, None) for m in self.methods()]
        titles = [f"p_{m}" for m, _ in names]
        spare = list(dict.fromkeys([*keep, *([self.group] if self.group else []), self.label]))
        rows = self._numbered(df, spare)
        schema = StructType([*[rows.schema[c] for c in spare], StructField("rep", IntegerType()), StructField("held_fold", IntegerType()), *[StructField(t, DoubleType()) for t in titles]])
        held = self._held(names)

        def run(batches):
            import pyarrow as pa

            for batch in batches:
                for r, fold, out in held(batch):
                    yield pa.RecordBatch.from_arrays(
                        [*[batch.column(c) for c in spare], pa.array(np.full(batch.num_rows, r), pa.int32()), pa.array(fold, pa.int32()),
                         *[pa.array(out[:, k], from_pandas=True) for k in range(len(names))]], names=schema.names)

        return rows.mapInArrow(run, schema)

    def _numbered(self, df: DataFrame, spare: Sequence[str]) -> DataFrame:
        return df.select(*spare, group_column(self.group).alias("__g"), *[F.col(f).cast("int").alias(f"__f{k}") for k, f in enumerate(self.folds)],
                         *[F.col(f"`{c}`").cast("double").alias(f"__x{k}") for k, c in enumerate(self.columns)])

    def _held(self, names: Sequence[tuple[str, int | None]]) -> Callable:
        """Of a batch, per repetition: its number, the folds, and a score for each row and (method, setting)."""
        models, best, count, reps = self.models, self.best, self.count, len(self.folds)
        columns = [f"__x{k}" for k in range(len(self.columns))]
        asked: dict[str, list[tuple[int, int | None]]] = {}
        for k, (m, s) in enumerate(names):
            asked.setdefault(m, []).append((k, s))

        def held(batch):
            x, group = numbers(batch, columns), np.array(batch.column("__g").to_pylist(), dtype=object)
            for r in range(reps):
                fold = batch.column(f"__f{r}").to_numpy(zero_copy_only=False)
                out = np.full((batch.num_rows, len(names)), np.nan)
                for g in set(group):
                    for f in range(count):
                        at = np.flatnonzero((group == g) & (fold == f))
                        if len(at):
                            mine = x[at]
                            for m, places in asked.items():
                                found = models.get((g, m), [])
                                chosen = [(k, best.get((g, m), 0) if s is None else s) for k, s in places]
                                some = [(k, found[s][r * count + f]) for k, s in chosen if s < len(found)]
                                for (k, _), scores in zip(some, score_settings([one for _, one in some], mine), strict=True):
                                    out[at, k] = scores
                yield r, fold, out

        return held

    def tune(self, df: DataFrame, metric: str = "ROC") -> DataFrame:
        """Choose each method's best setting by the mean over folds and repetitions; the first of equally good ones.

        ``metric`` is the area under the curve (``ROC``), or how near the curve comes to the corner (``Dist``, smaller is
        better). Gives ``grp, method, setting, value``.
        """
        names = [(m, k) for m in self.methods() for k in range(max(len(v) for (_, n), v in self.models.items() if n == m))]
        rows = self._numbered(df.where(F.col(self.label).isin(0, 1)), [self.label])
        if metric == "ROC":
            measured = held_areas(rows, self._held(names), [f"p_{m}__{s}" for m, s in names], self.label)
        elif metric == "Dist":
            held, label = self._held(names), self.label

            def run(batches):
                import pyarrow as pa

                # Straight to one row for each score: no plan over a column for each setting.
                for batch in batches:
                    for r, fold, out in held(batch):
                        kept = [batch.column("__g"), pa.array(np.full(batch.num_rows, r), pa.int32()), pa.array(fold, pa.int32()), batch.column(label)]
                        for k, (m, s) in enumerate(names):
                            yield long_batch(kept, ["grp", "rep", "held_fold", label], f"p_{m}__{s}", out[:, k])

            schema = StructType([StructField("grp", StringType()), StructField("rep", IntegerType()), StructField("held_fold", IntegerType()), rows.schema[label],
                                 StructField("model", StringType()), StructField("score", DoubleType())])
            by = ["grp", "model", "rep", "held_fold"]
            best = best_threshold(rows.mapInArrow(run, schema), "score", self.label, by=by)
            measured = best.select(*by, F.sqrt(F.pow(1 - F.col("sensitivity"), 2) + F.pow(1 - F.col("specificity"), 2)).alias("value"))
        else:
            raise ValueError(f"metric must be ROC or Dist, not {metric}")
        means = measured.groupBy("grp", "model").agg(F.avg("value").alias("value")).collect()
        rows = []
        sign = 1 if metric == "ROC" else -1
        for r in means:
            method, _, number = r["model"].removeprefix("p_").rpartition("__")
            rows.append((r["grp"], method, int(number), r["value"]))
        for g, m, k, v in sorted(rows, key=lambda x: x[2]):
            now = next((x[3] for x in rows if x[:2] == (g, m) and x[2] == self.best.get((g, m))), None)
            if v is not None and (now is None or sign * v > sign * now):
                self.best[g, m] = k
        return df.sparkSession.createDataFrame(rows, "grp string, method string, setting int, value double")


def held_areas(rows: DataFrame, held: Callable, titles: Sequence[str], label: str) -> DataFrame:
    """Area under the curve of held-out scores, ties counting half: ``grp, model, rep, held_fold, value``.

    ``held`` gives the scores of a batch, a column for each title. A score goes to one of a few ranges, so those of a range meet in
    one task as two arrays, of either label, and are ordered there; pairs of different ranges need numbers only.
    """
    key = "grp string, model string, rep int, held_fold int"

    def run(batches):
        import pyarrow as pa

        for batch in larger(batches, SCORED_ROWS):
            group, truth = np.array(batch.column("__g").to_pylist(), dtype=object), numbers(batch, [label])[:, 0].astype(np.int64)
            for r, fold, out in held(batch):
                parts: list[list] = [[] for _ in range(7)]
                for g in sorted(set(group)):
                    for f in np.unique(fold[group == g]):
                        if not np.isfinite(f):
                            continue
                        at = np.flatnonzero((group == g) & (fold == f))
                        for k, title in enumerate(titles):
                            score = out[at, k]
                            fine = np.isfinite(score)
                            score = score[fine]
                            place = 2 * np.minimum((np.clip(score, 0, 1) * RANGES).astype(np.int64), RANGES - 1) + truth[at][fine]
                            order = np.argsort(place, kind="stable")
                            ends = np.searchsorted(place[order], np.arange(2 * RANGES + 1))
                            score = score[order]
                            for part in range(RANGES):
                                low, middle, high = ends[2 * part:2 * part + 3]
                                if low < high:
                                    for values, one in zip(parts, (g, title, r, int(f), part, score[low:middle].tobytes(), score[middle:high].tobytes()), strict=True):
                                        values.append(one)
                kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(parts, kinds, strict=True)], names=["grp", "model", "rep", "held_fold", "part", "zeros", "ones"])

    def ordered(table):
        import pyarrow as pa

        zeros, ones = (np.sort(np.frombuffer(b"".join(table.column(c).to_pylist()))) for c in ("zeros", "ones"))
        # Of each zero, the ones above it and half of those that equal it.
        won = len(ones) * float(len(zeros)) - 0.5 * (np.searchsorted(ones, zeros, side="left").sum(dtype=float) + np.searchsorted(ones, zeros, side="right").sum(dtype=float))
        names = ["grp", "model", "rep", "held_fold", "part"]
        return pa.table([*[table.column(c).slice(0, 1) for c in names], pa.array([float(len(zeros))]), pa.array([float(len(ones))]), pa.array([won])], names=[*names, "n0", "n1", "won"])

    parts = rows.mapInArrow(run, f"{key}, part int, zeros binary, ones binary")
    by = ["grp", "model", "rep", "held_fold"]
    ranges = parts.groupBy(*by, "part").applyInArrow(ordered, f"{key}, part int, n0 double, n1 double, won double")
    each = ranges.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("part", "n0", "n1", "won"))).alias("parts"))
    total = F.aggregate("parts", F.struct(F.lit(0.0).alias("n0"), F.lit(0.0).alias("n1"), F.lit(0.0).alias("won")), lambda a, p: F.struct(
        (a["n0"] + p["n0"]).alias("n0"), (a["n1"] + p["n1"]).alias("n1"), (a["won"] + p["won"] + a["n0"] * p["n1"]).alias("won")))
    found = each.select(*by, total.alias("t"))
    return found.select(*by, F.try_divide(F.col("t.won"), F.col("t.n0") * F.col("t.n1")).alias("value"))


def column_marks(df: DataFrame, columns: Sequence[str], label: str, group: str | None) -> dict[str, np.ndarray]:
    """Per group 31 quantiles of every column over the usable rows."""
    usable = df.where(F.col(label).isin(0, 1))
    shares = [k / BINS for k in range(1, BINS)]
    found = usable.groupBy(group_column(group).alias("g")).agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), shares, 10000).alias(f"q{k}") for k, c in enumerate(columns)])
    return {r["g"]: np.array([r[f"q{k}"] or [0.0] * (BINS - 1) for k in range(len(columns))], dtype=float) for r in found.collect()}


def moments(blocks: Blocks, bases: Mapping[tuple[str, str], smooth.Basis], centre: Mapping[str, np.ndarray], count: int, spent: dict) -> dict[str, np.ndarray]:
    """Per group and fold cell the number, sums and products of the columns by class, and sums and squares of other terms."""

    def one(block: Block) -> dict[str, np.ndarray]:
        if block.lane:
            return {}
        x, out = block.x - centre[block.group], {}
        cells = block.trains(count)
        d = x.shape[1]
        for c in (0, 1):
            part = x[block.y == c]
            rows = cells[block.y == c].astype(float)
            out[f"{block.group}|n{c}"] = rows.sum(axis=0)
            out[f"{block.group}|s{c}"] = rows.T @ part
            out[f"{block.group}|q{c}"] = np.stack([(part.T @ (part * rows[:, [p]])) for p in range(rows.shape[1])]) if len(part) else np.zeros((cells.shape[1], d, d))
        for (g, method), basis in bases.items():
            if g == block.group and basis.kind != "raw":
                terms = basis.terms(block.x)
                out[f"{g}|{method}|s"], out[f"{g}|{method}|q"] = cells.T.astype(float) @ terms, cells.T.astype(float) @ terms ** 2
        return out

    begin = time.monotonic()
    out = totals(blocks, one)
    for key in bases:
        spent[key] = spent.get(key, 0.0) + (time.monotonic() - begin) / max(len(bases), 1)
    return out


def spread(n: float, total: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mean = total / max(n, 1)
    sd = np.sqrt(np.maximum(squares - n * mean ** 2, 0) / max(n - 1, 1))
    return mean, np.where(sd > 1e-9 * (1 + np.abs(mean)), sd, np.inf)


def fit_all(
    df: DataFrame, columns: Sequence[str], label: str, methods: Sequence[str], *, folds: Sequence[str], count: int, length: int = 1, group: str | None = None,
) -> Fits:
    """Fit every method at each of ``length`` settings for every problem of every group.

    ``folds`` are columns with the fold (0 to ``count`` - 1) of each row, one column for each repetition. Rows without a 0/1
    label or with a missing feature are left out. A problem with one class only gets its share of ones as constant score.
    Quantiles that become bins of trees and knots of hinges come from all rows of the group; labels are never looked at for them.
    """
    columns, folds = list(columns), list(folds)
    names = list(dict.fromkeys(known_method(m) for m in methods))
    blocks = pack(df, columns, label, folds, group)
    marks = column_marks(df, columns, label, group)
    spent: dict[tuple[str, str], float] = {}
    centre = {g: q[:, BINS // 2 - 1] for g, q in marks.items()}
    edges = {g: [np.unique(row) for row in q] for g, q in marks.items()}
    d, last = len(columns), len(folds) * count
    grids = {m: settings(m, length, d) for m in names}

    bases: dict[tuple[str, str], smooth.Basis] = {}
    for g, q in marks.items():
        for m in names:
            if m == "hinge_logistic":
                knots = []
                for k in range(d):
                    seen = np.unique(q[k])
                    # Of a column with two values one line says all.
                    marks_of = sorted({q[k, (i + 1) * BINS // (KNOTS + 1) - 1] for i in range(KNOTS)}) if len(seen) > 2 else []
                    knots += [(k, v, side) for v in marks_of for side in (1.0, -1.0)] or [(k, seen[0], 1.0)]
                bases[g, m] = smooth.Basis("hinges", dict(zip(("at", "knots", "sides"), (np.array(x) for x in zip(*knots, strict=True)), strict=True)))
            elif m in ("logistic", "elastic_net", "ridge_logistic", "linear_svm"):
                bases[g, m] = smooth.Basis("raw")
            elif m in ("component_net", "component_logistic"):
                bases[g, m] = smooth.Basis("raw")
            elif m == "radial_svm":
                for w in dict.fromkeys(s["width"] for s in grids[m]):
                    scale = np.where(q[:, -4] > q[:, 3], (q[:, -4] - q[:, 3]) / 2.3, 1.0)
                    bases[g, f"{m}@{w}"] = radial_basis(centre[g], scale, w / d)
    sums = moments(blocks, bases, centre, count, spent)

    models: dict[tuple[str, str], list[list[Fitted]]] = {}
    work: dict[tuple[str, str], tuple[smooth.Basis, list[smooth.Fit]]] = {}
    seats: dict[tuple[str, str], list[tuple[int, int, smooth.Fit, smooth.Basis]]] = {}
    forests: list[trees.Forest] = []
    boosters: list[trees.Forest] = []
    for g in sorted(marks):
        if f"{g}|n0" not in sums:
            continue
        n0, n1 = sums[f"{g}|n0"], sums[f"{g}|n1"]
        problems = range(last + 1)
        mixed = {p for p in problems if n0[p] >= 2 and n1[p] >= 2}
        total, square = sums[f"{g}|s0"] + sums[f"{g}|s1"], sums[f"{g}|q0"] + sums[f"{g}|q1"]
        for m in names:
            fits = [[Fitted(m, "constant", columns, s, {"value": np.array(n1[p] / max(n0[p] + n1[p], 1))}) for p in problems] for s in grids[m]]
            models[g, m] = fits
            if m in ("linear_discriminant", "shrunken_centroid", "naive_bayes"):
                begin = time.monotonic()
                for p in mixed:
                    means = [sums[f"{g}|s{c}"][p] / n for c, n in ((0, n0[p]), (1, n1[p]))]
                    scatter = square[p] - sum(n * np.outer(a, a) for n, a in zip((n0[p], n1[p]), means, strict=True))
                    for k, s in enumerate(grids[m]):
                        if m == "naive_bayes":
                            variance = [np.maximum(np.diag(sums[f"{g}|q{c}"][p]) / n - means[c] ** 2, 0) for c, n in ((0, n0[p]), (1, n1[p]))]
                            whole = np.diag(square[p]) / (n0[p] + n1[p]) - (total[p] / (n0[p] + n1[p])) ** 2
                            floor = 1e-9 * max(float(whole.max(initial=0)), 1e-300)
                            prior = np.log(np.array([n0[p], n1[p]]) / (n0[p] + n1[p]))
                            fits[k][p] = Fitted(m, "gaussian", columns, s, {"mean": np.stack(means) + centre[g], "variance": np.stack(variance) + floor, "prior": prior})
                        else:
                            weights, intercept = discriminant(n0[p], n1[p], means[0], means[1], scatter / max(1, n0[p] + n1[p] - 2), s.get("shrink", -1.0))
                            fits[k][p] = Fitted(m, "linear", columns, s, {"weights": weights, "intercept": np.array(intercept - weights @ centre[g])})
                spent[g, m] = spent.get((g, m), 0.0) + time.monotonic() - begin
            elif m in ("random_forest", "bagged_trees", "decision_tree"):
                deep = max(s["maxDepth"] for s in grids[m])
                number, drawn = {"random_forest": (TREES, True), "bagged_trees": (BAGS, True), "decision_tree": (1, False)}[m]
                share = math.ceil(math.sqrt(d)) / d if m == "random_forest" else 1.0
                base = {"random_forest": 0, "bagged_trees": 1000, "decision_tree": 2000}[m]
                forests.append(trees.Forest(m, g, [trees.Tree(p, base + t + SEED, deep) for p in sorted(mixed) for t in range(number)], share, drawn))
            elif m == "boosted_trees":
                start = {p: float(np.log(n1[p] / n0[p])) for p in mixed}
                before = {(p, s["maxDepth"]): [] for p in sorted(mixed) for s in grids[m]}
                boosters.append(trees.Forest(m, g, [], 1.0, False, True, start, before))
            else:
                for p in sorted(mixed):
                    n = n0[p] + n1[p]
                    for k, s in enumerate(grids[m]):
                        name = f"{m}@{s['width']}" if m == "radial_svm" else m
                        basis = bases[g, name]
                        if basis.kind == "raw":
                            mean, sd = spread(n, total[p], np.diag(square[p]))
                            mean = mean + centre[g]
                        else:
                            mean, sd = spread(n, sums[f"{g}|{name}|s"][p], sums[f"{g}|{name}|q"][p])
                        fit = dict(problem=p, setting=s, n=n, mean=mean, sd=sd)
                        if m in ("component_net", "component_logistic"):
                            inner = square[p] / n - np.outer(total[p], total[p]) / n ** 2
                            value, vectors = np.linalg.eigh(inner)
                            project = vectors[:, ::-1][:, :s["components"]]
                            fit |= dict(project=project, mean=(total[p] / n + centre[g]) @ project, sd=np.sqrt(np.maximum(value[::-1][:s["components"]] * n / max(n - 1, 1), 1e-18)))
                            fit |= dict(loss="net", l2=smooth.DECAY) if m == "component_net" else {}
                        elif m == "elastic_net" or m == "hinge_logistic":
                            fit |= dict(l1=0.5 * s["regParam"], l2=0.5 * s["regParam"])
                        elif m == "ridge_logistic":
                            fit |= dict(l2=s["regParam"])
                        elif m in ("linear_svm", "radial_svm"):
                            fit |= dict(loss="hinge", l2=s["regParam"])
                        made = smooth.Fit(**fit)
                        work.setdefault((g, name), (basis, []))[1].append(made)
                        seats.setdefault((g, m), []).append((k, p, made, basis))

    def smooths() -> None:
        smooth.solve(blocks, work, count, spent)

    def growing() -> None:
        trees.grow(blocks, forests, edges, count, spent)

    def boosting() -> None:
        trees.boost(blocks, boosters, edges, count, ROUNDS, spent)

    tasks: list[Callable[[], None]] = [t for t, some in ((smooths, work), (growing, forests), (boosting, boosters)) if some]
    try:
        together(df.sparkSession, tasks, most=3)
    finally:
        blocks.release()
    for (g, m), found in seats.items():
        for k, p, fit, basis in found:
            models[g, m][k][p] = smooth.fitted(m, columns, basis, fit)
    for forest in [*forests, *boosters]:
        for p in sorted({t.problem for t in forest.trees}):
            made = trees.fitted(forest, p, [s["maxDepth"] for s in grids[forest.method]], columns, edges[forest.group])
            for k, one in enumerate(made):
                models[forest.group, forest.method][k][p] = one
    elapsed = {}
    for (g, m), seconds in spent.items():
        elapsed[g, m.split("@")[0]] = elapsed.get((g, m.split("@")[0]), 0.0) + seconds
    return Fits(columns, label, folds, count, group, models, elapsed)


def radial_basis(centre: np.ndarray, scale: np.ndarray, width: float, features: int = FEATURES, seed: int = SEED) -> smooth.Basis:
    """Seeded random features whose products estimate exp(-width * squared distance) of scaled rows."""
    rng = np.random.default_rng(seed)
    return smooth.Basis("fourier", {
        "centre": np.asarray(centre, dtype=float), "scale": np.asarray(scale, dtype=float),
        "directions": rng.normal(0, math.sqrt(2 * width), (len(centre), features)), "phases": rng.uniform(0, 2 * math.pi, features)})
