"""What batched fits send to the driver does not grow with tasks, rows or settings."""

import numpy as np
from pyspark.sql import functions as F

from vigilo.plans import smooth, trees
from vigilo.plans.batched import fit_all
from vigilo.plans.blocks import pack, totals


def _rows(spark, n=4000):
    return spark.range(0, n, 1, 8).select((F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 97).cast("double").alias("a"), (F.col("id") % 31).cast("double").alias("b"))


def _collected(df, monkeypatch):
    kind, sizes = type(df), []
    real = kind.collect

    def collect(self):
        rows = real(self)
        sizes.append(sum(len(r["data"]) for r in rows) if "data" in self.columns else 0)
        return rows

    monkeypatch.setattr(kind, "collect", collect)
    return sizes


def test_the_driver_gets_each_sum_once(spark, monkeypatch):
    df = _rows(spark)
    blocks = pack(df, ["a", "b"], "y", [], None)
    assert blocks.tasks > 1
    sizes = _collected(df, monkeypatch)
    sums = totals(blocks, lambda block: {} if block.lane else {"wide": np.full((50, 8000), float(len(block.y))), "n": np.array([len(block.y)])})
    blocks.release()
    assert sums["n"].tolist() == [4000] and sums["wide"].shape == (50, 8000) and (sums["wide"] == 4000).all()
    assert sum(sizes) < 8 * 400_000 * 1.1


def test_the_driver_gets_cuts_and_not_histograms(spark, monkeypatch):
    df = _rows(spark)
    blocks = pack(df, ["a", "b"], "y", [], None)
    edges = {"": [np.arange(3.0, 96.0, 3.0), np.arange(0.0, 30.0)]}
    sizes = _collected(df, monkeypatch)
    forest = trees.Forest("bagged_trees", "", [trees.Tree(0, t, 4) for t in range(120)], 1.0, True)
    trees.grow(blocks, [forest], edges, 0, {})
    blocks.release()
    opened = sum(int((t.level < 4).sum()) for t in forest.trees)
    assert opened > 120 and all((t.feature >= 0).any() for t in forest.trees)
    # Small first levels may go straight; a histogram of these nodes holds 2 columns of 32 bins.
    assert sum(sizes) < 0.25 * blocks.tasks * opened * 2 * 32 * 2 * 8


def test_few_numbers_a_job_give_the_same_fits(spark, monkeypatch):
    df = _rows(spark).withColumn("y", (F.col("a") + F.col("b") + F.pmod(F.hash("a", "b"), F.lit(60)) > 80).cast("int"))
    whole = fit_all(df, ["a", "b"], "y", ["ridge_logistic", "elastic_net"], folds=[], count=0, length=3)
    monkeypatch.setattr(smooth, "NUMBERS", 10)
    parts = fit_all(df, ["a", "b"], "y", ["ridge_logistic", "elastic_net"], folds=[], count=0, length=3)
    for key, found in whole.models.items():
        for one, other in zip(found, parts.models[key], strict=True):
            assert np.allclose(one[0].arrays["weights"], other[0].arrays["weights"], rtol=1e-9)


def test_settings_of_a_forest_share_their_arrays(spark):
    fits = fit_all(_rows(spark), ["a", "b"], "y", ["random_forest"], folds=[], count=0, length=3)
    arrays = [one[0].arrays for one in fits.models["", "random_forest"]]
    assert arrays[0] is arrays[1] and arrays[1] is arrays[2]
