"""Vectors shared by the embedding operators: valid ones only, equal ones once."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, and at least one that is not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column, size: int | None = None) -> np.ndarray:
    """Rows of an Arrow list column of equal length as doubles."""
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, size or 0)


def rows_with_vectors(table: DataFrame, key: str, vector: str, *more: Column) -> DataFrame:
    """``id``, ``vec`` (doubles, null unless usable) and further columns."""
    vec = F.col(vector).cast("array<double>")
    return table.select(F.col(key).cast("long").alias("id"), F.when(usable(vec), vec).alias("vec"), *more)
