"""Fits of smooth losses for all settings, folds and groups at once: each pass sums one gradient and curvature per fit."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from vigilo.plans.blocks import Block, Blocks, totals
from vigilo.plans.fitted import Fitted, fourier_terms, hinge_terms, logistic

#: Half the width of the rounded corner of the hinge loss.
CORNER = 0.25
#: Passes over the rows at most.
PASSES = 25
#: Rounds of coordinate descent inside one step.
SWEEPS = 40
#: Fits of a method that a lane of a block does in one go.
SHARE = 8
#: Numbers that the fits of one job give; the others of a pass wait for its next job.
NUMBERS = 1_000_000
#: Numbers of the curvatures that take a sparse step side by side.
SIDE = 4_000_000
#: Hidden units of the component net and its weight decay.
HIDDEN, DECAY = 4, 1e-3


@dataclass
class Basis:
    """What the fits of one method and group see of a row: shared terms, or the leading components of each problem."""

    kind: str
    arrays: dict[str, np.ndarray] = field(default_factory=dict)

    def terms(self, x: np.ndarray) -> np.ndarray:
        a = self.arrays
        if self.kind == "hinges":
            return hinge_terms(x, a["at"], a["knots"], a["sides"])
        if self.kind == "fourier":
            return fourier_terms(x, a["centre"], a["scale"], a["directions"], a["phases"])
        return x


@dataclass
class Fit:
    """State of one fit: problem, penalties, and the damped step that is being tried. Terms are scaled by ``mean`` and ``sd``."""

    problem: int
    setting: dict
    n: float
    mean: np.ndarray
    sd: np.ndarray
    loss: str = "logistic"
    l1: float = 0.0
    l2: float = 0.0
    project: np.ndarray | None = None
    theta: np.ndarray = field(default_factory=lambda: np.empty(0))
    trial: np.ndarray = field(default_factory=lambda: np.empty(0))
    value: float = np.inf
    slope: np.ndarray | None = None
    curve: np.ndarray | None = None
    damping: float = 1e-9
    done: bool = False

    def __post_init__(self):
        self.theta = np.zeros(len(self.mean) + 1)
        if self.loss == "net":
            k = self.project.shape[1]
            # The same seeded start for every fit of one size.
            self.theta = np.random.default_rng(7).normal(0, 0.5, HIDDEN * (k + 2) + 1)
            self.damping = 1e-2
        self.trial = self.theta

    def raw(self, theta: np.ndarray) -> np.ndarray:
        """Intercept and weights for unscaled terms."""
        weights = theta[1:] / self.sd
        return np.concatenate([[theta[0] - weights @ self.mean], weights])

    def accept(self, loss: float, slope: np.ndarray, curve: np.ndarray) -> None:
        """Take the trial if the penalised loss did not grow, and plan the next step."""
        if self.loss != "net":
            scale = np.eye(len(slope))
            scale[1:, 1:] = np.diag(1 / self.sd)
            scale[0, 1:] = -self.mean / self.sd
            slope, curve = scale.T @ slope, scale.T @ curve @ scale
        bare = np.ones(len(slope))
        bare[0 if self.loss != "net" else -1] = 0
        value = loss / self.n + 0.5 * self.l2 * (bare * self.trial ** 2).sum() + self.l1 * np.abs(bare * self.trial).sum()
        better = value <= self.value + 1e-13 * abs(self.value) if np.isfinite(self.value) else True
        if better and np.isfinite(value):
            gained = self.value - value
            self.theta, self.value = self.trial, value
            self.slope = slope / self.n + self.l2 * bare * self.theta
            self.curve = curve / self.n + np.diag(self.l2 * bare)
            self.damping = max(self.damping / 8, 1e-12)
            self.done = gained < (1e-11 if self.loss == "logistic" else 1e-8) * (1 + abs(value))
        else:
            self.damping = max(self.damping * 16, 1e-6)
            self.done = self.damping > 1e8
        if not self.done and not self.l1:
            curve = self.curve + (self.damping + 1e-12 + 1e-10 * np.trace(self.curve) / len(self.curve)) * np.eye(len(self.slope))
            self.trial = self.theta - np.linalg.solve(curve, self.slope)


def _sparse_steps(fits: Sequence[Fit]) -> None:
    """Next trials of fits with an absolute penalty: coordinate descent on their quadratic models, all of one size side by side."""
    for size in sorted({len(f.theta) for f in fits}):
        same = [f for f in fits if len(f.theta) == size]
        most = max(1, SIDE // size ** 2)
        for first in range(0, len(same), most):
            _sparse_step(same[first:first + most], size)


def _sparse_step(some: Sequence[Fit], size: int) -> None:
    curve = np.stack([f.curve + (f.damping + 1e-12) * np.eye(size) for f in some])
    new, pull = np.stack([f.theta for f in some]), np.stack([f.slope for f in some])
    diagonal = np.maximum(np.einsum("kii->ki", curve), 1e-12)
    least = np.array([f.l1 for f in some])[:, None] / diagonal
    least[:, 0] = 0
    for _ in range(SWEEPS):
        most = 0.0
        for j in range(size):
            wanted = new[:, j] - pull[:, j] / diagonal[:, j]
            wanted = np.sign(wanted) * np.maximum(np.abs(wanted) - least[:, j], 0)
            move = wanted - new[:, j]
            if not move.any():
                continue
            pull += curve[:, j] * move[:, None]
            new[:, j] = wanted
            most = max(most, np.abs(move).max())
        if most < 1e-9:
            break
    for f, trial in zip(some, new, strict=True):
        f.trial = trial


def _losses(kind: str, z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, slope and curvature at each margin."""
    if kind == "hinge":
        sign = 2 * y - 1
        short = 1 - sign[:, None] * z
        inner = np.abs(short) <= CORNER
        loss = np.where(inner, (short + CORNER) ** 2 / (4 * CORNER), np.maximum(short, 0))
        slope = -sign[:, None] * np.where(inner, (short + CORNER) / (2 * CORNER), short > 0)
        return loss, slope, np.where(inner, 1 / (2 * CORNER), 0.0)
    p = logistic(z)
    return np.logaddexp(0, z) - y[:, None] * z, p - y[:, None], p * (1 - p)


@lru_cache(maxsize=64)
def _upper(size: int) -> np.ndarray:
    """Places of the upper half of a square array, row by row."""
    first, second = np.triu_indices(size)
    return first * size + second


def _gram(terms: np.ndarray, curve: np.ndarray) -> np.ndarray:
    """Upper half of the weighted products of the terms; only rows with a weight (of the hinge, those near its corner) are multiplied."""
    rows = np.flatnonzero(curve)
    if len(rows) < 0.8 * len(curve):
        terms, curve = terms.take(rows, axis=0), curve.take(rows)
    # One array times itself takes half the work.
    half = terms * np.sqrt(curve)[:, None]
    return (half.T @ half).take(_upper(terms.shape[1]))


def _shared(terms: np.ndarray, y: np.ndarray, fits: Sequence[tuple[int, str, np.ndarray]], masks: np.ndarray) -> np.ndarray:
    """Per fit its loss, slope and the upper half of its curvature over a block; all fits see the same terms, the first of them one."""
    m, out = terms.shape[1], np.empty((len(fits), 1 + terms.shape[1] + terms.shape[1] * (terms.shape[1] + 1) // 2))
    z = terms @ np.column_stack([w for _, _, w in fits])
    rows = masks[:, [p for p, _, _ in fits]]
    loss, slope, curve = _losses(fits[0][1], z, y)
    out[:, 0], out[:, 1:1 + m] = (loss * rows).sum(axis=0), (terms.T @ (slope * rows)).T
    curve = np.ascontiguousarray((curve * rows).T)
    for k in range(len(fits)):
        out[k, 1 + m:] = _gram(terms, curve[k])
    return out


def _net(x: np.ndarray, y: np.ndarray, theta: np.ndarray, k: int) -> np.ndarray:
    """The same of a net over ``x``, which holds a row for each component: long rows are quicker to multiply."""
    inner, offset, outer, bias = np.split(theta, [k * HIDDEN, (k + 1) * HIDDEN, (k + 2) * HIDDEN])
    hidden = logistic(inner.reshape(k, HIDDEN).T @ x + offset[:, None])
    z = outer @ hidden + bias[0]
    loss, slope, curve = (a[:, 0] for a in _losses("logistic", z[:, None], y))
    size = len(theta)
    moves = np.empty((size, x.shape[1]))
    back = moves[k * HIDDEN:(k + 1) * HIDDEN]
    np.multiply(hidden, 1 - hidden, out=back)
    back *= outer[:, None]
    for i in range(k):
        np.multiply(back, x[i], out=moves[i * HIDDEN:(i + 1) * HIDDEN])
    moves[(k + 1) * HIDDEN:-1], moves[-1] = hidden, 1
    out = np.empty(1 + size + size * (size + 1) // 2)
    out[0], out[1:1 + size] = loss.sum(), moves @ slope
    moves *= np.sqrt(curve)
    out[1 + size:] = (moves @ moves.T).take(_upper(size))
    return out


def _projected(block: Block, fits: Sequence[tuple[int, str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]], masks: np.ndarray) -> list[np.ndarray]:
    """The same where every fit has its own components."""
    out, last = [], None
    for problem, loss, theta, project, mean, sd in fits:
        if problem != last:
            rows, last = np.flatnonzero(masks[:, problem]), problem
            y, seen = block.y.take(rows), block.x.take(rows, axis=0)
        if loss == "net":
            x = (project / sd).T @ seen.T
            x -= (mean / sd)[:, None]
            out.append(_net(x, y, theta, project.shape[1]))
        else:
            out.append(_shared(_with_one(seen @ project), y, [(0, "logistic", theta)], np.ones((len(y), 1)))[0])
    return out


def _with_one(terms: np.ndarray) -> np.ndarray:
    out = np.empty((len(terms), 1 + terms.shape[1]))
    out[:, 0], out[:, 1:] = 1, terms
    return out


def solve(blocks: Blocks, work: Mapping[tuple[str, str], tuple[Basis, list[Fit]]], folds: int, spent: dict[tuple[str, str], float]) -> None:
    """Run all fits, keyed by (group, method), to their ends; each pass is one job for all that are not done.

    ``spent`` collects the seconds that tasks used for each.
    """
    for _ in range(PASSES):
        live = {key: [k for k, f in enumerate(fits) if not f.done] for key, (_, fits) in work.items()}
        live = {key: found for key, found in live.items() if found}
        if not live:
            return
        items = [(key, found[first:first + SHARE]) for key, found in live.items() for first in range(0, len(found), SHARE)]
        while items:
            some, numbers = [], 0
            while items and (not some or numbers + _numbers(work, *items[0]) <= NUMBERS):
                numbers += _numbers(work, *items[0])
                some.append(items.pop(0))
            _step(blocks, work, some, numbers, folds, spent)
        _sparse_steps([f for _, fits in work.values() for f in fits if f.l1 and not f.done])


def _numbers(work: Mapping[tuple[str, str], tuple[Basis, list[Fit]]], key: tuple[str, str], found: Sequence[int]) -> int:
    sizes = [len(work[key][1][k].trial) for k in found]
    return sum(1 + m + m * (m + 1) // 2 for m in sizes)


def _step(
    blocks: Blocks, work: Mapping[tuple[str, str], tuple[Basis, list[Fit]]], items: Sequence[tuple[tuple[str, str], list[int]]], numbers: int, folds: int,
    spent: dict[tuple[str, str], float],
) -> None:
    """One job: loss, slope and curvature of the fits of ``items`` (key and numbers of its fits), which then plan their next trials."""
    asked: dict[str, list] = {}
    for item, (key, found) in enumerate(items):
        basis, fits = work[key][0], [work[key][1][k] for k in found]
        if fits[0].project is None:
            sent = [(f.problem, f.loss, f.raw(f.trial)) for f in fits]
        else:
            sent = [(f.problem, f.loss, f.trial if f.loss == "net" else f.raw(f.trial), f.project, f.mean, f.sd) for f in fits]
        asked.setdefault(key[0], []).append((item, basis if fits[0].project is None else None, sent))
    count = len(items)

    def one(block: Block) -> dict[str, np.ndarray]:
        if block.group not in asked:
            return {}
        masks, took = block.trains(folds), np.zeros(count)
        out: dict[str, np.ndarray] = {}
        # The terms of one basis at a time: the fits that share it follow each other.
        last: tuple[Basis | None, np.ndarray | None] = None, None
        for place, (item, basis, fits) in enumerate(asked[block.group]):
            if block.mine(place):
                begin = time.perf_counter()
                if basis is None:
                    out[str(item)] = np.concatenate(_projected(block, fits, masks))
                else:
                    if last[0] is not basis:
                        last = basis, _with_one(basis.terms(block.x))
                    out[str(item)] = _shared(last[1], block.y, fits, masks).ravel()
                took[item] = time.perf_counter() - begin
        return out | {"time": took}

    sums = totals(blocks, one, size=numbers + count)
    for item, (key, found) in enumerate(items):
        spent[key] = spent.get(key, 0.0) + float(sums["time"][item])
        flat, at = sums.pop(str(item)), 0
        for k in found:
            fit = work[key][1][k]
            size = len(fit.trial)
            end = at + 1 + size + size * (size + 1) // 2
            half = np.zeros((size, size))
            half[np.triu_indices(size)] = flat[at + 1 + size:end]
            fit.accept(flat[at], flat[at + 1:at + 1 + size], half + np.triu(half, 1).T)
            at = end


def fitted(method: str, columns: list[str], basis: Basis, fit: Fit) -> Fitted:
    """The finished fit as a classifier over unscaled columns."""
    if fit.loss == "net":
        k = fit.project.shape[1]
        inner, offset, outer, bias = np.split(fit.theta, [k * HIDDEN, (k + 1) * HIDDEN, (k + 2) * HIDDEN])
        scaled = inner.reshape(k, HIDDEN) / fit.sd[:, None]
        return Fitted(method, "net", columns, fit.setting, {
            "inner": fit.project @ scaled, "inner_intercept": offset - fit.mean @ scaled, "weights": outer, "intercept": bias[0]})
    raw = fit.raw(fit.theta)
    arrays = {"weights": raw[1:], "intercept": raw[0]}
    if fit.project is not None:
        arrays["weights"] = fit.project @ raw[1:]
    kind = {"raw": "linear", "hinges": "hinges", "fourier": "fourier"}[basis.kind]
    return Fitted(method, kind, columns, fit.setting, basis.arrays | arrays)
