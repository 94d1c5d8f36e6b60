"""Nearest neighbours: a navigable small-world graph per shard, held as flat neighbour arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilo.llm.common import batches_of, table
from vigilo.llm.units import unit_rows
from vigilo.llm.vectors import matrix, rows_with_vectors
from vigilo.sources.tables import stage

#: Vectors in a shard, and queries that are searched together.
SHARD, QUERIES = 4096, 512
#: Tasks that shards are dealt to: some for each shard, so that few meet in one, and so many at most.
TASKS_A_SHARD, MOST_TASKS = 4, 100_000
#: Neighbours kept above the lowest layer (twice as many on it), and beams for building and searching.
LINKS, BUILD_BEAM, SEARCH_BEAM = 16, 96, 192
_WAVE = 256


class Graph:
    """A hierarchical graph over the rows of ``x``.

    ``links[l]`` is a flat array of neighbour numbers of layer l, -1 where a row has fewer; rows that are not
    on the layer have none. Rows are added in waves: a wave searches the graph as it stands, its members
    also see each other, and every new row takes its nearest candidates that are nearer to it than to one
    taken before; links back are pruned the same way.
    """

    def __init__(self, x: np.ndarray, links: list[np.ndarray], entry: int):
        self.x, self.links, self.entry = x, links, entry

    @classmethod
    def build(cls, x: np.ndarray, seed: int = 0) -> Graph:
        n = len(x)
        level = np.minimum(np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(LINKS)), 6).astype(int)
        order = np.argsort(-level, kind="stable")
        graph = cls(x, [np.full((n, LINKS * (1 if k else 2)), -1, dtype=np.int32) for k in range(int(level.max(initial=0)) + 1)], int(order[0]) if n else 0)
        at, wave = 1, 1
        # The rows of upper layers come first, so every layer is built on a finished one above it.
        while at < n:
            new = order[at:at + wave]
            graph._add(new, level[new])
            at, wave = at + len(new), min(_WAVE, at + len(new))
        return graph

    def _add(self, new: np.ndarray, level: np.ndarray) -> None:
        start = np.full((len(new), 1), self.entry)
        for layer in range(len(self.links) - 1, -1, -1):
            found, dist = self.beam(self.x[new], start, layer, BUILD_BEAM)
            here = level >= layer
            start = np.where(found[:, :8] >= 0, found[:, :8], self.entry)
            if here.any():
                own = new[here]
                mutual = self.distances(self.x[own], np.broadcast_to(own, (len(own), len(own))))
                np.fill_diagonal(mutual, np.inf)
                ids = np.concatenate([found[here], np.broadcast_to(own, (len(own), len(own)))], 1)
                far = np.concatenate([dist[here], mutual], 1)
                self._link(own, ids, far, layer)

    def _choose(self, ids: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates up to ``most``, nearest first, dropping those nearer to a taken one."""
        width = min(ids.shape[1], 3 * most)
        near = np.argsort(dist, axis=1, kind="stable")[:, :width]
        ids, dist = np.take_along_axis(ids, near, 1), np.take_along_axis(dist, near, 1)
        alive = np.isfinite(dist)
        v = self.x[np.maximum(ids, 0)]
        # Relative to the nearest candidate: squares of near copies would lose what tells them apart.
        v -= v[:, :1].copy()
        sq = np.einsum("nmd,nmd->nm", v, v)
        between = sq[:, :, None] + sq[:, None, :] - 2 * (v @ v.transpose(0, 2, 1))
        taken = np.zeros(ids.shape, dtype=bool)
        count = np.zeros(len(ids), dtype=int)
        for k in range(width):
            covered = (taken & (between[:, :, k] < dist[:, k, None])).any(1)
            take = alive[:, k] & ~covered & (count < most)
            taken[:, k] = take
            count += take
        # Places left over go to the nearest that were covered.
        rank = np.where(taken, 0, np.where(alive, 1, 2)) * width + np.arange(width)
        best = np.argsort(rank, axis=1)[:, :most]
        out = np.where(np.take_along_axis(alive, best, 1), np.take_along_axis(ids, best, 1), -1)
        return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)

    def _link(self, own: np.ndarray, ids: np.ndarray, dist: np.ndarray, layer: int) -> None:
        flat = self.links[layer]
        most = flat.shape[1]
        flat[own] = chosen = self._choose(ids, np.where(ids >= 0, dist, np.inf), most)
        back, there = np.nonzero(chosen >= 0)
        target, source = chosen[back, there], own[back]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        rows, first, counts = np.unique(target, return_index=True, return_counts=True)
        extra = np.full((len(rows), counts.max(initial=0)), -1, dtype=np.int64)
        extra[np.repeat(np.arange(len(rows)), counts), np.arange(len(target)) - np.repeat(first, counts)] = source
        old = flat[rows]
        extra[(extra[:, :, None] == old[:, None, :]).any(2)] = -1
        free = (old >= 0).sum(1) + (extra >= 0).sum(1) <= most
        both = np.concatenate([old, extra], 1)
        if free.any():
            packed = np.take_along_axis(both[free], np.argsort(both[free] < 0, axis=1, kind="stable"), 1)
            flat[rows[free]] = packed[:, :most]
        full = np.flatnonzero(~free)
        for at in range(0, len(full), _WAVE):
            r = full[at:at + _WAVE]
            far = np.where(both[r] >= 0, self.distances(self.x[rows[r]], both[r]), np.inf)
            flat[rows[r]] = self._choose(both[r], far, most)

    def distances(self, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances of each query to its own row of ids, from differences."""
        apart = self.x[ids]
        apart -= q[:, None, :]
        return np.einsum("nmd,nmd->nm", apart, apart)

    def beam(self, q: np.ndarray, start: np.ndarray, layer: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest rows found for each query, nearest first (-1 and inf where fewer)."""
        flat, n, step = self.links[layer], len(q), 4
        seen = np.zeros((n, len(self.x) + 1), dtype=bool)
        seen[:, -1] = True
        ids = np.full((n, width), -1, dtype=np.int64)
        dist = np.full((n, width), np.inf, dtype=self.x.dtype)
        done = np.ones((n, width), dtype=bool)
        # Repeated starts count once.
        start = np.sort(start, axis=1)
        fresh = np.concatenate([np.ones((n, 1), bool), start[:, 1:] != start[:, :-1]], 1)
        first = np.where(fresh, self.distances(q, start), np.inf)
        k = start.shape[1]
        ids[:, :k], dist[:, :k], done[:, :k] = np.where(fresh, start, -1), first, ~fresh
        np.put_along_axis(seen, start, True, 1)
        live = np.arange(n)
        while len(live):
            waiting = np.where(done[live], np.inf, dist[live])
            pick = np.argpartition(waiting, step - 1, axis=1)[:, :step]
            open_ = np.isfinite(np.take_along_axis(waiting, pick, 1))
            some = open_.any(1)
            live, pick, open_ = live[some], pick[some], open_[some]
            if not len(live):
                break
            rows = np.arange(len(live))[:, None]
            done[live[:, None], pick] = True
            around = np.where(open_[:, :, None], flat[np.maximum(ids[live[:, None], pick], 0)], -1).reshape(len(live), -1)
            around = np.sort(around, axis=1)
            around[:, 1:][around[:, 1:] == around[:, :-1]] = -1
            around[seen[live[:, None], around]] = -1
            seen[live[:, None], around] = True
            far = np.where(around >= 0, self.distances(q[live], around), np.inf)
            all_dist = np.concatenate([dist[live], far.astype(dist.dtype)], 1)
            best = np.argpartition(all_dist, width - 1, axis=1)[:, :width]
            dist[live] = all_dist[rows, best]
            ids[live] = np.concatenate([ids[live], around], 1)[rows, best]
            done[live] = np.concatenate([done[live], around < 0], 1)[rows, best]
        order = np.argsort(dist, axis=1, kind="stable")
        ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
        return np.where(np.isfinite(dist), ids, -1), dist

    def search(self, q: np.ndarray, width: int) -> np.ndarray:
        start = np.full((len(q), 1), self.entry)
        for layer in range(len(self.links) - 1, 0, -1):
            start = self.beam(q, start, layer, 8)[0]
            start = np.where(start >= 0, start, start[:, :1])
        return self.beam(q, start, 0, width)[0]


def _scaled(x: np.ndarray, by: float) -> np.ndarray:
    """Vectors by a common factor, those of a query so far out that squares would overflow drawn in along their direction."""
    x = x / by
    return x / np.maximum(np.abs(x).max(axis=1, keepdims=True, initial=0) / 1e150, 1)


def _tasks(shards: int) -> int:
    return min(max(1, TASKS_A_SHARD * shards), MOST_TASKS)


_INDEX = "grp int, shard long, n int, dim int, layers int, entry int, vectors binary, links binary, ids array<array<bigint>>"


def build_index(vectors: DataFrame, key: str, vector: str, keep: int) -> DataFrame:
    """One row per shard: its vectors (doubles), flat neighbour arrays, and the ids of each vector.

    Equal vectors are one point and carry their ``keep`` smallest ids, which is all that a search for
    ``keep - 1`` neighbours can return of them. Vectors of different length are in different shards.
    """
    rows = rows_with_vectors(vectors, key, vector).where("vec is not null and id is not null")
    slot = Window.partitionBy("vec").orderBy("id")
    ranked = rows.distinct().withColumn("slot", F.row_number().over(slot)).where(F.col("slot") <= keep)
    points = ranked.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("grp", F.size("vec"))
    points = stage(points, "points")
    shards = points.groupBy("grp").agg(F.ceil(F.count("*") / SHARD).alias("shards"))
    dealt = points.join(shards, "grp").select("grp", F.pmod(F.xxhash64("vec"), F.col("shards")).alias("shard"), "vec", "ids")
    # Building is costly and its input small: with a set number of tasks, adaptive execution does not put shards together.
    dealt = dealt.repartition(_tasks(int(shards.agg(F.sum("shards")).first()[0] or 0)), "grp", "shard")

    def build(part):
        import pyarrow as pa

        part = part.combine_chunks()
        x = matrix(part.column("vec").chunk(0))
        graph = Graph.build(_scaled(x, np.abs(x).max()))
        return pa.table({
            "grp": part.column("grp").slice(0, 1), "shard": part.column("shard").slice(0, 1), "n": pa.array([len(x)], pa.int32()),
            "dim": pa.array([x.shape[1]], pa.int32()), "layers": pa.array([len(graph.links)], pa.int32()), "entry": pa.array([graph.entry], pa.int32()),
            "vectors": pa.array([x.tobytes()], pa.binary()), "links": pa.array([b"".join(a.tobytes() for a in graph.links)], pa.binary()),
            "ids": pa.array([part.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64())))})

    return stage(dealt.groupBy("grp", "shard").applyInArrow(build, _INDEX), "hnsw")


def read_graph(row: dict) -> tuple[Graph, np.ndarray]:
    n, dim = row["n"], row["dim"]
    x = np.frombuffer(row["vectors"]).reshape(n, dim)
    links, at = [], 0
    for layer in range(row["layers"]):
        size = n * LINKS * (1 if layer else 2)
        links.append(np.frombuffer(row["links"], np.int32, size, 4 * at).reshape(n, -1))
        at += size
    return Graph(_scaled(x, np.abs(x).max()), links, row["entry"]), x


def nearest(queries: DataFrame, index: DataFrame, key: str, vector: str, k: int = 10) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (Euclidean distance) of the k nearest found.

    Blocks of ``QUERIES`` queries go to every shard. A task holds the graph of one shard and reads the blocks one after the
    other, so a graph is moved once and queries of any number fit. Each block returns at most k rows a query, which a ranking per query
    merges. Distances are double precision throughout, scores those of the original vectors. All points as
    near as the last one taken are kept until ids break the tie; a query never finds its own id.

    Nulls: queries that are null, empty, zero or hold null or non-finite components, or whose id is null,
    get no row; nor do queries of a length that no candidate has. Repeated queries count once.
    """
    asked = rows_with_vectors(queries, key, vector).where("vec is not null and id is not null").dropDuplicates(["id"])
    asked = asked.withColumn("grp", F.size("vec"))
    cuts = asked.groupBy("grp").agg(F.ceil(F.count("*") / QUERIES).alias("cuts"))
    dealt = asked.join(cuts, "grp").withColumn("cut", F.pmod(F.xxhash64("id"), F.col("cuts")))
    packs = dealt.groupBy("grp", "cut").agg(F.collect_list(F.struct("id", "vec")).alias("asked"))
    # The row of a shard lies in front of the blocks that search it.
    sent = packs.join(index.select("grp", "shard"), "grp")
    rows = index.withColumn("cut", F.lit(-1).cast("long")).unionByName(sent, allowMissingColumns=True)
    rows = rows.repartition(_tasks(index.count()), "grp", "shard").sortWithinPartitions("grp", "shard", "cut")

    def search(batches):
        import pyarrow as pa

        graph = x = ids = None
        for row in unit_rows(batches):
            if row["cut"] < 0:
                (graph, x), ids = read_graph(row), row["ids"]
                continue
            q = np.array([a["vec"] for a in row["asked"]], dtype=np.float64)
            found = graph.search(_scaled(q, np.abs(x).max()), max(SEARCH_BEAM, 2 * k))
            out = ([], [], [])
            for a, own, cand in zip(row["asked"], q, found, strict=True):
                cand = cand[cand >= 0]
                dist = np.sqrt(np.einsum("nd,nd->n", x[cand] - own, x[cand] - own))
                # One more than k, as one may be the query itself, and all that are as near as that one.
                last = np.partition(dist, k)[k] if len(dist) > k else np.inf
                near = sorted((d, i) for c, d in zip(cand, dist, strict=True) if d <= last for i in ids[c] if i != a["id"])
                for d, i in near[:k]:
                    out[0].append(a["id"])
                    out[1].append(i)
                    out[2].append(float(d))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["query_id", "vec_id", "score"])

    with batches_of(index.sparkSession, 1):
        found = stage(rows.mapInArrow(search, "query_id long, vec_id long, score double"), "nearest")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_nearest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    index = build_index(vectors, "vec_id", "embedding", 11)
    return nearest(vectors.where(F.col("vec_id") % 100 == 0), index, "vec_id", "embedding", 10)
