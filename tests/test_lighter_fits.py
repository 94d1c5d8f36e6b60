"""Batched fits do no more work per row than they need."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilo.operators.evaluate import roc_auc
from vigilo.plans import batched, smooth, trees
from vigilo.plans.blocks import Block, joined, pack, totals
from vigilo.plans.fitted import Fitted, score_settings


def _blocks(number=3, rows=200, d=6):
    rng = np.random.default_rng(1)
    return [Block(k, "", rng.normal(size=(rows, d)), rng.integers(0, 2, rows).astype(float), np.zeros((rows, 0), dtype=np.int16)) for k in range(number)]


def test_joined_blocks_hold_the_same_rows_and_draws():
    blocks = _blocks() + [Block(9, "other", np.ones((5, 6)), np.ones(5), np.zeros((5, 0), dtype=np.int16))]
    whole, other = sorted(joined(blocks, 10**6), key=lambda b: b.group)
    assert np.array_equal(whole.x, np.concatenate([b.x for b in blocks[:3]])) and len(other.y) == 5
    assert np.array_equal(whole.draws(4), np.concatenate([b.draws(4) for b in blocks[:3]]))
    assert [len(b.y) for b in joined(blocks, 0)] == [200, 200, 200, 5]


def test_a_task_joins_its_blocks(spark):
    rows = spark.range(0, 30_000, 1, 2).select((F.col("id") % 2).cast("int").alias("y"), F.col("id").cast("double").alias("a"))
    blocks = pack(rows, ["a"], "y", [], None)
    count = lambda join: totals(blocks, lambda b: {} if b.lane else {"n": [1, len(b.y)]}, join=join)["n"].tolist()
    apart, together = count(0), count(10**6)
    tasks = blocks.tasks
    blocks.release()
    assert apart[1] == together[1] == 30_000 and together[0] <= tasks < apart[0]


def test_histograms_hold_tried_columns_only_and_find_the_best_cut(monkeypatch):
    blocks, shapes = _blocks(), []

    def local(_, work, *, size=None, finish=None, join=0):
        sums = {}
        for block in joined(blocks, join):
            for name, part in work(block).items():
                sums[name] = sums.get(name, 0) + part
        shapes.extend(v.shape for k, v in sums.items() if k != "time")
        return {name: finish(name, 0, v) for name, v in sums.items()}

    monkeypatch.setattr(trees, "totals", local)
    x, y = (np.concatenate([getattr(b, n) for b in blocks]) for n in ("x", "y"))
    edges = [np.quantile(x[:, k], np.arange(1, 32) / 32) for k in range(6)]
    forest = trees.Forest("random_forest", "", [trees.Tree(0, seed, 1) for seed in range(20)], 0.5, True)
    trees.grow(None, [forest], {"": edges}, 0, {})
    assert {s[1:] for s in shapes} == {(3, 32, 2)}
    bins = trees.bins_of(x, edges)
    for tree in forest.trees:
        weight = np.concatenate([b.draws(tree.seed) for b in blocks])
        order = np.random.default_rng((tree.seed, 0)).random((1, 6)).argsort(axis=1).argsort(axis=1)[0]
        gini = lambda on: 2 * (weight * y)[on].sum() * (weight * (1 - y))[on].sum() / max(weight[on].sum(), 1)
        best = min((gini(bins[:, k] <= c) + gini(bins[:, k] > c), k, c) for k in range(6) if order[k] < 3 for c in range(31) if (weight * (bins[:, k] <= c)).any() and (weight * (bins[:, k] > c)).any())
        assert abs(gini(bins[:, tree.feature[0]] <= tree.cut[0]) + gini(bins[:, tree.feature[0]] > tree.cut[0]) - best[0]) < 1e-9 and order[tree.feature[0]] < 3


def test_rows_away_from_the_corner_are_not_multiplied():
    rng = np.random.default_rng(2)
    terms, curve = rng.normal(size=(50, 4)), np.where(np.arange(50) < 20, 2.0, 0.0)
    want = (terms.T @ (terms * curve[:, None]))[np.triu_indices(4)]
    terms[20:] = np.nan
    assert np.allclose(smooth._gram(terms, curve), want, rtol=1e-12)


def test_areas_of_settings_are_those_of_every_score(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(a), float(b), i % 2 if i % 7 else 1, i % 4) for i, (a, b) in enumerate(rng.integers(-6, 7, (900, 2)))]
    df = spark.createDataFrame([*rows, (900, 1.0, 1.0, 0, None), (901, None, 1.0, 1, 2)], "id int, a double, b double, y int, fold int").repartition(3)
    one = lambda w, b=0.0: [Fitted("m", "linear", ["a", "b"], {}, {"weights": np.array(w), "intercept": np.array(b)})] * 5
    fits = batched.Fits(["a", "b"], "y", ["fold"], 4, None, {("", "m"): [one([0.3, 0.1]), one([-2.0, 4.0], 40.0), one([0.0, 0.0])]}, {})
    names = [("m", k) for k in range(3)]
    got = {(r["model"], r["held_fold"]): r["value"] for r in batched.held_areas(fits._numbered(df, ["y"]), fits._held(names), [f"p_m__{k}" for k in range(3)], "y").collect()}
    assert len(got) == 12
    for k in range(3):
        fit = fits.models["", "m"][k][0]
        for f in range(4):
            want = roc_auc(fit.transform(df.where(F.col("fold") == f)), "p", "y").first()["auc"]
            assert got[f"p_m__{k}", f] == pytest.approx(want, abs=1e-14), (k, f)


def test_depths_of_a_forest_are_read_off_on_one_way_down(spark):
    rows = spark.range(0, 2000, 1, 2).select((F.pmod(F.hash("id"), F.lit(3)) > 0).cast("int").alias("y"), (F.col("id") % 97).cast("double").alias("a"), (F.col("id") % 31).cast("double").alias("b"))
    fits = [one[0] for one in batched.fit_all(rows, ["a", "b"], "y", ["random_forest"], folds=[], count=0, length=3).models["", "random_forest"]]
    x = np.array([[5.0, 3.0], [np.nan, 1.0], [90.0, 30.0]])
    found = score_settings(fits, x)
    assert len({f[0] for f in found}) > 1 and all(np.array_equal(one, f.score(x), equal_nan=True) for one, f in zip(found, fits, strict=True))
