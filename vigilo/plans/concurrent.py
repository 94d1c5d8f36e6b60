"""Independent fits side by side: each is spread over the executors, their small stages fill the gaps."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def together(spark: SparkSession, tasks: Sequence[Callable[[], T]], *, most: int | None = None) -> list[T]:
    """Results of the tasks in order; two thirds of the default parallelism run at a time unless ``most`` is given."""
    workers = most or max(1, math.ceil(spark.sparkContext.defaultParallelism / 1.5))
    with ThreadPoolExecutor(max_workers=min(workers, max(1, len(tasks)))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(t)) for t in tasks]]
