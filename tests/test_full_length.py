"""Held-out predictions are tuned over every setting."""

from bindings import models
from vigilo.plans import batched, ensemble


def test_held_out_predictions_are_tuned_over_all_settings(spark, monkeypatch):
    asked = {}
    df = spark.createDataFrame([(i, i % 2, "traindata", i % 10) for i in range(20)], "id int, y int, split string, fold int")
    monkeypatch.setattr(models, "_folded", lambda *_: df)
    monkeypatch.setattr(ensemble, "tune_members", lambda *_, **more: (asked.update(more), batched.Fits([], "y", [], 0, None, {}, {}))[1])
    monkeypatch.setattr(ensemble, "held_scores", lambda *_, **__: df)
    assert models.oof_predictions(spark, "").count() == 20
    assert asked["length"] == 16 and asked["folds"] == 10
