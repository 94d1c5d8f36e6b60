"""Settings of a search run."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Control:
    mode: str
    upsample: str
    length: int
    folds: int
    reps: int
    metric: str = "ROC"
    core_share: float = 1.5

    def parallelism(self, spark: SparkSession, most: int | None = None) -> int:
        """Fits submitted at a time, at most ``most`` if given; each fit is itself spread over the executors."""
        share = math.ceil(spark.sparkContext.defaultParallelism / self.core_share)
        return max(1, share if most is None else min(most, share))


# The three run modes.
MODES = {
    "DEV": Control("DEV", "SMOTE", length=4, folds=5, reps=1, core_share=2.0),
    "PROD": Control("PROD", "SMOTE", length=9, folds=10, reps=3),
    "TEST": Control("TEST", "NONE", length=6, folds=10, reps=3),
}


def control(mode: str, grade: int | None = None) -> Control:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {sorted(MODES)}")
    return MODES[mode]
