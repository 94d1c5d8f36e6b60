"""Fitted models, scalers and result tables kept between stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def save_table(df: DataFrame, path: str, *, partition_by: Sequence[str] = ("grade", "year")) -> None:
    """Search results, predictions, scalers or validation rows, one partition per cohort.

    Only the cohorts present in ``df`` are replaced.
    """
    keys = [c for c in partition_by if c in df.columns]
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*keys) if keys else writer).parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
