"""Exact nearest neighbours of vectors among themselves.

Vectors are assigned to the nearest of some pivots and compared inside their cells first. The farthest
neighbour found there, or what the distances between pivots allow, bounds how far the vector has to look;
it is then sent only to the cells its own ball can reach. Cells that are too full are cut into blocks, so the
rows one task compares are bounded and nothing is left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilo.functions.hashing import digest, leading_int
from vigilo.sources.tables import stage

CELL_ROWS = 2000
MAX_PIVOTS = 1024
CHUNK_CELLS = 2_000_000
_SLACK = 1 + 1e-9


def _coords(vectors: pd.Series, scale: np.ndarray) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype("float64") / scale


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    out = np.empty((len(points), len(pivots)))
    for j, p in enumerate(pivots):
        out[:, j] = np.sqrt(((points - p) ** 2).sum(axis=1))
    return out


def _closest(x: np.ndarray, y: np.ndarray, mine: np.ndarray, theirs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of ``x`` the ``k`` nearest other rows of ``y``: its number, theirs and the distance, ties by the vectors ``theirs``.

    Products rule out what is too far; what is left is measured by differences.
    """
    rank = np.empty(len(y), dtype=np.int64)
    rank[np.lexsort(theirs.T[::-1])] = np.arange(len(y))
    middle = np.nan_to_num(y).mean(axis=0)
    u, v = x - middle, y - middle
    u2, v2 = (u ** 2).sum(axis=1), (v ** 2).sum(axis=1)
    slack = 1e-12 * (np.nan_to_num(u2).max() + np.nan_to_num(v2).max())
    parts = []
    step = max(1, CHUNK_CELLS // len(y))
    for start in range(0, len(x), step):
        about = u2[start:start + step, None] + v2 - 2 * (u[start:start + step] @ v.T)
        about[np.isnan(about)] = np.inf
        limit = np.partition(about, k, axis=1)[:, k] if len(y) > k else np.full(len(about), np.inf)
        i, j = np.nonzero(about <= limit[:, None] + slack)
        i += start
        far = np.sqrt(((y[j] - x[i]) ** 2).sum(axis=1))
        fine = np.isfinite(far) & ~((far == 0) & (mine[i] == theirs[j]).all(axis=1))
        i, j, far = i[fine], j[fine], far[fine]
        order = np.lexsort((rank[j], far, i))
        i, j, far = i[order], j[order], far[order]
        first = np.searchsorted(i, i, side="left")
        near = np.arange(len(i)) - first < k
        parts.append((i[near], j[near], far[near]))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def nearest_vectors(vectors: DataFrame, k: int, *, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``(vec, n)`` distinct vectors -> ``(vec, n, near)`` with the ``k`` nearest others.

    Each coordinate is divided by its range first; a constant one counts nothing. ``near`` is
    sorted by distance, then by vector, and holds ``distance``, ``vec`` and ``n``.
    """
    none = F.array().cast("array<struct<distance:double,vec:array<double>,n:bigint>>")
    shape = vectors.agg(F.count(F.lit(1)).alias("m"), F.max(F.size("vec")).alias("d")).first()
    m, d = shape["m"], shape["d"]
    if not m:
        return vectors.select("vec", "n", none.alias("near"))
    at = [F.col("vec")[i] for i in range(d)]
    ends = vectors.agg(F.array(*[F.max(c) for c in at]).alias("hi"), F.array(*[F.min(c) for c in at]).alias("lo")).first()
    spans = np.array(ends["hi"], dtype="float64") - np.array(ends["lo"], dtype="float64")
    scale = np.where(spans > 0, spans, np.inf)

    count = int(min(MAX_PIVOTS, max(1, -(-m // cell_rows))))
    order = digest(F.array_join("vec", ","))
    pivots = np.stack([np.array(r["vec"]) for r in vectors.orderBy(order, "vec").limit(count).collect()]) / scale

    def assign(batches):
        for pdf in batches:
            far = _distances(_coords(pdf["vec"], scale), pivots)
            cell = far.argmin(axis=1)
            yield pdf.assign(cell=cell, away=far[np.arange(len(far)), cell])

    schema = "vec array<double>, n long, cell int, away double"
    cells = stage(vectors.select("vec", "n").mapInPandas(assign, schema), "cells")

    nearest_first = Window.partitionBy("cell").orderBy("away")
    firsts = cells.withColumn("r", F.row_number().over(nearest_first)).where(F.col("r") <= k + 1).select("cell", "away")
    inner = [(r["cell"], r["away"]) for r in firsts.collect()]
    radius = np.full(len(pivots), -np.inf)
    members = np.zeros(len(pivots), dtype="int64")
    reached = F.max(F.when(~F.isnan("away"), F.col("away")))
    for r in cells.groupBy("cell").agg(reached.alias("u"), F.count(F.lit(1)).alias("c")).collect():
        radius[r["cell"]], members[r["cell"]] = -np.inf if r["u"] is None else r["u"], r["c"]

    between = _distances(pivots, pivots)
    home = np.array([c for c, _ in inner])
    step = np.array([a for _, a in inner])
    bound = np.full(len(pivots), np.inf)
    if len(inner) > k:
        for i in np.flatnonzero(members):
            bound[i] = np.partition(radius[i] + between[i, home] + step, k)[k]
    bound *= _SLACK
    block = leading_int(order)
    schema = "vec array<double>, n long, cell int, distance double, other array<double>, m long"

    def compared(asking: DataFrame, loads: np.ndarray, *, own: bool) -> DataFrame:
        """The nearest members of the cell of each asking row (``vec, n, cell, limit``), not beyond its limit."""
        spread = cells.sparkSession.createDataFrame(
            [(i, max(1, -(-int(loads[i]) // cell_rows)), max(1, -(-int(members[i]) // cell_rows))) for i in range(len(pivots)) if members[i]],
            "cell int, lefts int, rights int",
        )

        def blocked(df: DataFrame, one: str, other: str, *more: str) -> DataFrame:
            # At most MAX_PIVOTS rows are broadcast here.
            wide = df.join(F.broadcast(spread), "cell")
            mine = F.pmod(block, F.col(f"{one}s")).cast("int").alias(one)
            theirs = F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)).alias(other)
            return wide.select("cell", "vec", "n", *more, mine, theirs)

        def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            out = pd.DataFrame({c: [] for c in ("vec", "n", "cell", "distance", "other", "m")}, dtype=object)
            if not len(a):
                return out
            mine, numbers, cell = a["vec"].to_numpy(), a["n"].to_numpy(), int(a["cell"].iloc[0])
            if len(b):
                theirs = b["vec"].to_numpy()
                plain, others = _coords(a["vec"], 1.0), _coords(b["vec"], 1.0)
                i, j, far = _closest(plain / scale, others / scale, plain, others, k)
                fine = far <= a["limit"].to_numpy()[i]
                i, j, far = i[fine], j[fine], far[fine]
                out = pd.DataFrame({"vec": mine[i], "n": numbers[i], "cell": cell, "distance": far, "other": theirs[j], "m": b["n"].to_numpy()[j]}).astype({"vec": object, "other": object})
            if own:
                # A row without a neighbour in its cell goes on as well.
                none_yet = pd.DataFrame({"vec": mine, "n": numbers, "cell": cell, "distance": np.inf, "other": [[]] * len(a), "m": 0})
                out = pd.concat([out, none_yet], ignore_index=True) if len(out) else none_yet
            return out

        left = blocked(asking, "left", "right", "limit")
        # Columns of their own: a cogroup of one table with itself is ambiguous.
        right = blocked(cells.select(*[F.col(c).alias(c) for c in ("vec", "n", "cell")]), "right", "left")
        right = right.select(*[F.col(c).alias(c) for c in right.columns])
        return left.groupBy("cell", "left", "right").cogroup(right.groupBy("cell", "left", "right")).applyInPandas(compare, schema)

    entry = F.struct("distance", F.col("other").alias("vec"), F.col("m").alias("n"))
    found = compared(cells.select("vec", "n", "cell", F.lit(float("inf")).alias("limit")), members, own=True)
    home_near = stage(found.groupBy("vec", "n").agg(F.max("cell").alias("cell"), F.slice(F.array_sort(F.collect_list(entry)), 1, k).alias("near")), "near")
    last = F.coalesce(F.get("near", F.lit(k - 1))["distance"], F.lit(float("inf")))

    def reach(batches):
        for pdf in batches:
            far = _distances(_coords(pdf["vec"], scale), pivots)
            cell = pdf["cell"].to_numpy()
            away = far[np.arange(len(cell)), cell][:, None]
            limit = np.fmin(pdf["limit"].to_numpy() * _SLACK, bound[cell])
            apart = between[cell]
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = np.where(apart > 1e-6, (far**2 - away**2) / (2 * apart), 0.0)
                least = np.maximum(plane, far - radius[None, :])
            near = (least <= limit[:, None] + 1e-9) & (members[None, :] > 0)
            near[np.arange(len(cell)), cell] = False
            row, target = np.nonzero(near)
            picked = pdf.iloc[row][["vec", "n"]].reset_index(drop=True)
            picked["cell"], picked["limit"] = target, limit[row]
            yield picked.astype({"vec": object})

    parts = home_near.select("vec", "n", F.inline(F.transform("near", lambda s: F.struct(s["distance"].alias("distance"), s["vec"].alias("other"), s["n"].alias("m")))))
    if len(pivots) > 1:
        sent = stage(home_near.select("vec", "n", "cell", last.alias("limit")).mapInPandas(reach, "vec array<double>, n long, cell int, limit double"), "sent")
        loads = np.zeros(len(pivots), dtype="int64")
        for r in sent.groupBy("cell").agg(F.count(F.lit(1)).alias("c")).collect():
            loads[r["cell"]] = r["c"]
        parts = parts.unionByName(compared(sent, loads, own=False).drop("cell"))
    best = parts.where(F.col("distance") < float("inf")).groupBy("vec", "n").agg(F.slice(F.array_sort(F.collect_list(entry)), 1, k).alias("near"))
    alone = vectors.select("vec", "n").where(F.lit(m == 1))
    return best.unionByName(alone.withColumn("near", none))
