"""Rows packed into blocks of numbers, and sums of arrays over all blocks: the one Spark job every batched fit is made of."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.sources.tables import stage

#: Sums of more tasks than this are added in two steps on the executors.
DIRECT_TASKS = 64
#: Bytes of the sums of all tasks that may go straight to the driver in one job, and numbers of a piece that is added up on its own.
DIRECT_BYTES, PIECE = 1 << 20, 1 << 15
#: Rows of a block at most, and blocks of a task where there are enough for every core.
BLOCK_ROWS, TASK_BLOCKS = 2048, 64
#: Numbers of the features that are joined to one block for work whose result is as large for few rows as for many.
JOINED = 1 << 18
#: Name of the group of rows without one.
MISSING_GROUP = "\0missing"


@dataclass
class Block:
    """Rows of one group: features, 0/1 labels, and the fold of each row in every repetition.

    ``parts`` are the number and the rows of each packed block in it, one unless several are joined.
    """

    number: int
    group: str
    x: np.ndarray
    y: np.ndarray
    folds: np.ndarray
    lane: int = 0
    lanes: int = 1
    parts: tuple[tuple[int, int], ...] = ()

    def draws(self, seed: int) -> np.ndarray:
        """How often each row is drawn with replacement: the same for a seed in every pass, however blocks are joined."""
        return np.concatenate([np.random.default_rng((number, seed)).poisson(1.0, n) for number, n in self.parts or [(self.number, len(self.y))]])

    def mine(self, item: int) -> bool:
        """Whether this lane does the item; where blocks are fewer than cores, each block has several lanes that share the work."""
        return item % self.lanes == self.lane

    def trains(self, count: int) -> np.ndarray:
        """Which rows each problem learns from: one problem per repetition and fold that leaves the fold out, and one of all rows."""
        left_out = self.folds[:, :, None] == np.arange(count)
        return np.concatenate([~left_out.reshape(len(self.y), self.folds.shape[1] * count), np.ones((len(self.y), 1), dtype=bool)], axis=1)


def group_column(group: str | None):
    """The group as text; a missing one is a group of its own."""
    return F.lit("") if group is None else F.coalesce(F.col(group).cast("string"), F.lit(MISSING_GROUP))


@dataclass
class Blocks:
    """The packed rows in the shared folder, kept in memory between passes until released."""

    table: DataFrame
    tasks: int

    def release(self) -> None:
        self.table.unpersist()


def pack(df: DataFrame, columns: Sequence[str], label: str, folds: Sequence[str], group: str | None) -> Blocks:
    """Blocks of the usable rows (label 0 or 1, no feature missing), written once; every pass reads them."""
    d, r = len(columns), len(folds)
    rows = df.where(F.col(label).isin(0, 1)).select(
        group_column(group).alias("g"), F.col(label).cast("double").alias("y"), *[F.col(f).cast("double").alias(f"f{k}") for k, f in enumerate(folds)],
        *[F.col(f"`{c}`").cast("double").alias(f"x{k}") for k, c in enumerate(columns)])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), dtype=object)
            flat = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(1, 2 + r + d)])
            fine = np.isfinite(flat[:, 1 + r:]).all(axis=1)
            for name in sorted(set(names[fine])):
                whole = flat[fine & (names == name)]
                for at in range(0, len(whole), BLOCK_ROWS):
                    part = whole[at:at + BLOCK_ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([len(part)], pa.int32())]
                        + [pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in (part[:, 1 + r:], part[:, 0], part[:, 1:1 + r].astype(np.int16))],
                        names=["g", "n", "x", "y", "f"])

    packed = rows.mapInArrow(run, "g string, n int, x binary, y binary, f binary")
    table = stage(packed.withColumn("block", F.monotonically_increasing_id()), "blocks")
    cores, count, tasks = df.sparkSession.sparkContext.defaultParallelism, table.count(), table.rdd.getNumPartitions()
    lanes = max(1, cores // max(count, 1))
    table = table.withColumn("lanes", F.lit(lanes)).withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    if tasks < min(cores, count * lanes):
        tasks = min(count * lanes, cores)
        table = table.repartition(tasks)
    elif tasks > max(2 * cores, -(-count // TASK_BLOCKS)):
        # Every task gives whole sums: fewer tasks with more rows each move less.
        tasks = max(2 * cores, -(-count // TASK_BLOCKS))
        table = table.coalesce(tasks)
    return Blocks(table.persist(), tasks)


def read_blocks(batches) -> Iterable[Block]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            n = row["n"]
            yield Block(row["block"], row["g"], np.frombuffer(row["x"]).reshape(n, -1), np.frombuffer(row["y"]), np.frombuffer(row["f"], dtype=np.int16).reshape(n, -1),
                        row["lane"], row["lanes"])


def joined(blocks: Iterable[Block], numbers: int) -> Iterable[Block]:
    """Blocks of one group and lane side by side, until their features hold ``numbers`` numbers."""
    waiting: dict[tuple[str, int], list[Block]] = {}
    for block in blocks:
        some = waiting.setdefault((block.group, block.lane), [])
        some.append(block)
        if sum(b.x.size for b in some) >= numbers:
            yield _join(waiting.pop((block.group, block.lane)))
    for some in waiting.values():
        yield _join(some)


def _join(some: Sequence[Block]) -> Block:
    first = some[0]
    x, y, folds = (np.concatenate([getattr(b, name) for b in some]) if len(some) > 1 else getattr(first, name) for name in ("x", "y", "folds"))
    return Block(first.number, first.group, x, y, folds, first.lane, first.lanes, tuple((b.number, len(b.y)) for b in some))


def _rows(sums: Mapping[str, np.ndarray], task: int):
    """The arrays, cut along their first axis into pieces."""
    import pyarrow as pa

    for name, total in sums.items():
        step = max(1, PIECE // max(1, math.prod(total.shape[1:])))
        for piece, at in enumerate(range(0, max(1, len(total)), step)):
            yield _row(name, piece, at, task, total[at:at + step], pa)


def _row(name: str, piece: int, at: int, task: int, part: np.ndarray, pa):
    return pa.RecordBatch.from_arrays(
        [pa.array([name]), pa.array([piece], pa.int32()), pa.array([at], pa.int32()), pa.array([task], pa.int32()), pa.array([json.dumps(part.shape)]),
         pa.array([np.ascontiguousarray(part, dtype=np.float64).tobytes()], pa.binary())],
        names=["name", "piece", "at", "task", "shape", "data"])


def _read(shape: str, data: bytes) -> np.ndarray:
    return np.frombuffer(data).reshape(json.loads(shape))


def totals(
    blocks: Blocks, work: Callable[[Block], Mapping[str, np.ndarray]], *, size: int | None = None, finish: Callable[[str, int, np.ndarray], np.ndarray] | None = None,
    join: int = 0,
) -> dict[str, np.ndarray]:
    """Sums over all blocks of the named arrays that ``work`` gives for each.

    ``work`` sees a block once in each of its lanes and must give each of its arrays in one lane only. A task adds up its own blocks. Unless the
    arrays of all tasks are small (``size`` says how many numbers one task gives), the executors add them piece by piece, in two steps where
    there are many tasks, so that the driver gets each sum once. ``finish`` sees the name, the first row and the sum of
    each piece (whole rows of the first axis) and gives what the driver needs of it, a row for each. With ``join`` a task joins its
    blocks up to so many numbers of features before ``work`` sees them.
    """
    schema = "name string, piece int, at int, task int, shape string, data binary"

    def partial(batches):
        from pyspark import TaskContext

        sums: dict[str, np.ndarray] = {}
        for block in joined(read_blocks(batches), join):
            for name, part in work(block).items():
                if name in sums:
                    sums[name] += part
                else:
                    sums[name] = np.array(part, dtype=np.float64, ndmin=1)
        yield from _rows(sums, TaskContext.get().partitionId())

    def added(last: bool):
        def add(part):
            import pyarrow as pa

            total = None
            shapes, data = part.column("shape"), part.column("data")
            # In the order of the tasks, so that a repeated run gives the same bits.
            for k in np.argsort(part.column("task").to_numpy(), kind="stable"):
                one = _read(shapes[k].as_py(), data[k].as_py())
                total = one.copy() if total is None else total + one
            name, piece, at, task = (part.column(c)[0].as_py() for c in ("name", "piece", "at", "task"))
            if last and finish is not None:
                total = finish(name, at, total)
            return pa.Table.from_batches([_row(name, piece, at, task, total, pa)])

        return add

    sums = blocks.table.mapInArrow(partial, schema)
    direct = size is not None and 8 * size * blocks.tasks <= DIRECT_BYTES
    if not direct:
        if blocks.tasks > DIRECT_TASKS:
            sums = sums.withColumn("task", F.pmod("task", F.lit(math.isqrt(blocks.tasks)))).groupBy("name", "piece", "task").applyInArrow(added(False), schema)
        sums = sums.groupBy("name", "piece").applyInArrow(added(True), schema)
    found: dict[tuple[str, int, int], np.ndarray] = {}
    for r in sums.collect():
        one, key = _read(r["shape"], bytes(r["data"])), (r["name"], r["piece"], r["at"])
        found[key] = found[key] + one if key in found else one
    out: dict[str, list[np.ndarray]] = {}
    for name, piece, at in sorted(found):
        one = found.pop((name, piece, at))
        out.setdefault(name, []).append(finish(name, at, one) if direct and finish is not None else one)
    return {name: np.concatenate(parts) for name, parts in out.items()}
