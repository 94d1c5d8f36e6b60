"""Trees of all settings, folds and groups grown together: each pass sums one histogram per open node."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from vigilo.plans.blocks import JOINED, Block, Blocks, totals
from vigilo.plans.fitted import Fitted, logistic

#: Numbers in the histograms of one pass; trees wait for the next one beyond that.
CELLS = 4_000_000
#: Trees of a forest that a lane of a block does in one go.
SHARE = 16
#: Steps of a boosted model, and what is added to the curvature of a leaf.
RATE, RIDGE = 0.1, 1.0


@dataclass
class Tree:
    """A growing tree. Node arrays; ``left`` is followed by its sibling. ``open`` are nodes that may still be split."""

    problem: int
    seed: int
    depth: int
    feature: np.ndarray = field(default_factory=lambda: np.full(1, -1, dtype=np.int32))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.int32))
    left: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(1))
    level: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.int32))
    gain: np.ndarray = field(default_factory=lambda: np.zeros(1))
    open: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.int64))

    def route(self) -> tuple:
        return self.feature, self.cut, self.left, self.level.max() if len(self.level) else 0


def _ends(flat: np.ndarray, starts: np.ndarray, route: tuple) -> np.ndarray:
    """The node in which each row ends whose bins begin at ``starts``."""
    feature, cut, left, depth = route
    inner = feature >= 0
    # A leaf leads to itself: no bin is beyond its cut.
    column, cut = np.where(inner, feature, 0).astype(np.int64), np.where(inner, cut, np.iinfo(flat.dtype).max).astype(flat.dtype)
    left = np.where(inner, left, np.arange(len(left))).astype(np.int64)
    node = np.zeros(len(starts), dtype=np.int64)
    for _ in range(int(depth)):
        beyond = flat.take(starts + column.take(node)) > cut.take(node)
        node = left.take(node)
        node += beyond
    return node


@dataclass
class Forest:
    """The trees of one method and group: ``share`` of the columns tried at a node, rows drawn with replacement or not.

    A boosted one keeps the trees of earlier rounds in ``before``, per problem and depth.
    """

    method: str
    group: str
    trees: list[Tree]
    share: float
    drawn: bool
    boosted: bool = False
    start: dict[int, float] = field(default_factory=dict)
    before: dict[tuple[int, int], list[Tree]] = field(default_factory=dict)


def bins_of(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Number of each value's bin: how many edges are smaller."""
    out = np.empty(x.shape, dtype=np.int16)
    for k, e in enumerate(edges):
        out[:, k] = np.searchsorted(e, x[:, k], side="left")
    return out


def tried_number(share: float, d: int) -> int:
    """Columns that are tried at a node."""
    return d if share >= 1 else max(1, int(np.ceil(share * d)))


def _tried(seed: int, level: int, count: int, d: int, most: int) -> np.ndarray:
    """The columns tried at each of the open nodes of a level, in their order."""
    order = np.random.default_rng((seed, level)).random((count, d)).argsort(axis=1).argsort(axis=1)
    return np.nonzero(order < most)[1].reshape(count, most)


def _impurity(weight: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Weight times Gini impurity."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(weight > 0, 2 * ones * (weight - ones) / weight, 0.0)


def _choose(cells: np.ndarray, boosted: bool, d: int, trees: Sequence[tuple[int, int, int]], start: int) -> np.ndarray:
    """The best split of each node by its histogram (node, tried column, bin, two sums): best gain, first column and bin on ties.

    The nodes are those from ``start`` on of ``trees`` (seed, level and number of open nodes of each). A row holds the place of
    the cut among all ``d`` columns, its gain, and both sums of the node, of its left and of its right side.
    """
    sums = cells.cumsum(axis=2)
    whole = sums[:, 0, -1]
    left = sums[:, :, :-1]
    right = whole[:, None, None] - left
    if boosted:
        fit = lambda a: a[..., 1] ** 2 / (a[..., 0] + RIDGE)
        gain = fit(left) + fit(right) - fit(whole)[:, None, None]
        least = 1e-3
    else:
        gain = _impurity(*np.moveaxis(whole, -1, 0))[:, None, None] - _impurity(*np.moveaxis(left, -1, 0)) - _impurity(*np.moveaxis(right, -1, 0))
        least = 1.0 - 1e-9
    gain = np.where((left[..., 0] >= least) & (right[..., 0] >= least), gain, -np.inf)
    nodes, most, cuts = gain.shape
    out = np.zeros((nodes, 8))
    out[:, 1], out[:, 2:4] = -np.inf, whole
    flat, rows = gain.reshape(nodes, -1), np.arange(nodes)
    if flat.shape[1]:
        best = flat.argmax(axis=1)
        out[:, 0], out[:, 1] = best, flat[rows, best]
        out[:, 4:6], out[:, 6:8] = left[rows, best // cuts, best % cuts], right[rows, best // cuts, best % cuts]
        before = 0
        for seed, level, count in trees if most < d else ():
            first, last = max(start, before), min(start + nodes, before + count)
            if first < last:
                some = best[first - start:last - start]
                columns = _tried(seed, level, count, d, most)[first - before:last - before]
                out[first - start:last - start, 0] = columns[np.arange(last - first), some // cuts] * cuts + some % cuts
            before += count
    return out


def _split(tree: Tree, found: np.ndarray, boosted: bool, cuts: int) -> None:
    """Split the open nodes as :func:`_choose` found."""
    nodes = tree.open
    leaf = (lambda s: RATE * s[:, 1] / (s[:, 0] + RIDGE)) if boosted else (lambda s: s[:, 1] / np.maximum(s[:, 0], 1e-300))
    tree.value[nodes] = leaf(found[:, 2:4])
    best, size = found[:, 0].astype(np.int64), found[:, 1]
    good = np.flatnonzero(size > 1e-9)
    parents = nodes[good]
    new = len(tree.feature) + 2 * np.arange(len(good))
    tree.feature[parents], tree.cut[parents] = best[good] // max(cuts, 1), best[good] % max(cuts, 1)
    tree.left[parents], tree.gain[parents] = new, size[good]
    for name, fill in (("feature", -1), ("cut", 0), ("left", 0), ("value", 0.0), ("gain", 0.0)):
        old = getattr(tree, name)
        setattr(tree, name, np.concatenate([old, np.full(2 * len(good), fill, dtype=old.dtype)]))
    depth = np.repeat(tree.level[parents] + 1, 2)
    children = np.arange(len(tree.level), len(tree.level) + 2 * len(good))
    tree.level = np.concatenate([tree.level, depth.astype(np.int32)])
    # Children get their values here, so the last level needs no pass of its own.
    pair = found[good, 4:8].reshape(-1, 2)
    tree.value[children] = leaf(pair)
    more = depth < tree.depth
    if not boosted:
        more = more & (pair[:, 0] >= 2) & (pair[:, 1] > 1e-9) & (pair[:, 1] < pair[:, 0] - 1e-9)
    tree.open = children[more]


def _pass(blocks: Blocks, chosen: list[tuple[Forest, list[Tree]]], edges: dict[str, list[np.ndarray]], folds: int, spent: dict) -> None:
    """One job: histograms of the open nodes of the chosen trees, the best cut of each where they are added up; then they are split."""
    asked: dict[str, list] = {}
    seen: dict[str, tuple] = {}
    cells = 0
    for number, (forest, trees) in enumerate(chosen):
        d, most = len(edges[forest.group]), max(len(e) for e in edges[forest.group]) + 1
        used = tried_number(forest.share, d)
        cells += sum(len(t.open) for t in trees) * used * most * 2
        for first in range(0, len(trees), SHARE):
            seen[f"h|{number}|{first}"] = forest.boosted, d, [(t.seed, int(t.level[t.open[0]]), len(t.open)) for t in trees[first:first + SHARE]]
            sent = [(t.problem, t.seed, int(t.level[t.open[0]]), t.route(), t.open, [b.route() + (b.value,) for b in forest.before.get((t.problem, t.depth), [])], forest.start.get(t.problem, 0.0))
                    for t in trees[first:first + SHARE]]
            asked.setdefault(forest.group, []).append((number, first, forest.drawn, forest.boosted, used, sent))

    def one(block: Block) -> dict[str, np.ndarray]:
        out = {}
        if block.group not in asked:
            return out
        bins, masks = bins_of(block.x, edges[block.group]), block.trains(folds)
        n, d = bins.shape
        most = max(len(e) for e in edges[block.group]) + 1
        flat, starts = bins.ravel(), np.arange(n) * d
        margins: dict[int, np.ndarray] = {}
        draws: dict[int, np.ndarray] = {}
        took = np.zeros(len(chosen))
        for item, (number, chunk, drawn, boosted, used, sent) in enumerate(asked[block.group]):
            if not block.mine(item):
                continue
            begin = time.perf_counter()
            width = used * most
            sizes = [len(open_) * width for _, _, _, _, open_, _, _ in sent]
            part, at_cell = np.empty((sum(sizes), 2)), 0
            for (problem, seed, level, route, open_, before, start), size in zip(sent, sizes, strict=True):
                mine = masks[:, problem]
                if drawn:
                    # The same draws in every pass and for every problem of a tree.
                    if seed not in draws:
                        draws[seed] = block.draws(seed)
                    mine = mine & (draws[seed] > 0)
                rows = np.flatnonzero(mine)
                place = np.full(len(route[0]), -1, dtype=np.int64)
                place[open_] = np.arange(len(open_))
                at = place.take(_ends(flat, starts.take(rows), route))
                inside = np.flatnonzero(at >= 0)
                rows, at = rows.take(inside), at.take(inside)
                first = starts.take(rows)
                # A row of cells for each tried column.
                cell = np.empty((used, len(rows)), dtype=np.int64)
                columns = None if used == d else _tried(seed, level, len(open_), d, used)
                begins = at * width
                for k in range(used):
                    np.add(begins, flat.take(first + (k if columns is None else columns[:, k].take(at))), out=cell[k])
                    cell[k] += k * most
                found = part[at_cell:at_cell + size]
                if boosted:
                    key = id(before) if before else (problem, 0)
                    if key not in margins:
                        margins[key] = sum((value.take(_ends(flat, starts, (f, c, le, depth))) for f, c, le, depth, value in before), np.full(n, start))
                    p = logistic(margins[key].take(rows))
                    for c, values in enumerate((p * (1 - p), block.y.take(rows) - p)):
                        found[:, c] = np.bincount(cell.ravel(), np.tile(values, used), size)
                else:
                    # Both classes are counted side by side; then the first sum is that of both.
                    cell *= 2
                    cell += block.y.take(rows).astype(np.int64)
                    counts = np.bincount(cell.ravel(), np.tile(draws[seed].take(rows).astype(np.float64), used) if drawn else None, 2 * size).reshape(size, 2)
                    found[:, 1] = counts[:, 1]
                    found[:, 0] = counts[:, 0] + counts[:, 1]
                at_cell += size
            out[f"h|{number}|{chunk}"] = part.reshape(-1, used, most, 2)
            took[number] += time.perf_counter() - begin
        return out | {"time": took}

    def best(name: str, start: int, part: np.ndarray) -> np.ndarray:
        return part if name == "time" else _choose(part, *seen[name], start)

    sums = totals(blocks, one, size=cells + len(chosen), finish=best, join=JOINED)
    for number, (forest, trees) in enumerate(chosen):
        cuts = max(len(e) for e in edges[forest.group])
        found, at = np.concatenate([sums[f"h|{number}|{first}"] for first in range(0, len(trees), SHARE)]), 0
        spent[forest.group, forest.method] = spent.get((forest.group, forest.method), 0.0) + float(sums["time"][number])
        for tree in trees:
            count = len(tree.open)
            _split(tree, found[at:at + count], forest.boosted, cuts)
            at += count


def grow(blocks: Blocks, forests: Sequence[Forest], edges: dict[str, list[np.ndarray]], folds: int, spent: dict[tuple[str, str], float]) -> None:
    """Grow all trees level by level until none has open nodes; as many trees share a job as the histograms allow."""
    while True:
        chosen, cells = [], 0
        for forest in forests:
            width = tried_number(forest.share, len(edges[forest.group])) * (max((len(e) for e in edges[forest.group]), default=0) + 1) * 2
            taken = []
            for tree in forest.trees:
                if not len(tree.open):
                    continue
                need = len(tree.open) * width
                if cells and cells + need > CELLS:
                    continue
                cells += need
                taken.append(tree)
            if taken:
                chosen.append((forest, taken))
        if not chosen:
            return
        _pass(blocks, chosen, edges, folds, spent)


def boost(blocks: Blocks, forests: Sequence[Forest], edges: dict[str, list[np.ndarray]], folds: int, rounds: int, spent: dict[tuple[str, str], float]) -> None:
    """Rounds of one tree per problem and depth, each fitted to what the trees before it leave."""
    for r in range(rounds):
        for forest in forests:
            forest.trees = [Tree(p, r, depth) for p, depth in sorted(forest.before)]
        grow(blocks, forests, edges, folds, spent)
        for forest in forests:
            for tree in forest.trees:
                forest.before[tree.problem, tree.depth].append(tree)


def _arrays(trees: Sequence[Tree], edges: list[np.ndarray]) -> dict[str, np.ndarray]:
    sizes = np.array([len(t.feature) for t in trees])
    roots = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    feature = np.concatenate([t.feature for t in trees])
    cut = np.concatenate([t.cut for t in trees])
    # A cut past the last edge never occurs: its right side would be empty.
    threshold = np.array([edges[f][c] if f >= 0 else 0.0 for f, c in zip(feature, cut, strict=True)])
    return {"roots": roots, "feature": feature, "threshold": threshold, "left": np.concatenate([t.left.astype(np.int64) + r for t, r in zip(trees, roots, strict=True)]),
            "value": np.concatenate([t.value for t in trees]), "depth": np.concatenate([t.level for t in trees]), "gain": np.concatenate([t.gain for t in trees])}


def fitted(forest: Forest, problem: int, depths: Sequence[int], columns: list[str], edges: list[np.ndarray]) -> list[Fitted]:
    """The trees of a problem cut off at each of ``depths``: deeper settings only add to them, so all share the same arrays."""
    if forest.boosted:
        return [Fitted(forest.method, "boosted", columns, {"maxDepth": depth}, _arrays(forest.before[problem, depth], edges) | {"start": np.array(forest.start[problem])})
                for depth in depths]
    arrays = _arrays([t for t in forest.trees if t.problem == problem], edges)
    return [Fitted(forest.method, "forest", columns, {"maxDepth": depth}, arrays) for depth in depths]
