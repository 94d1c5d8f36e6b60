"""Warehouse scans and shared staging tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LISTENING: list[list[str]] = []
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def load(spark: SparkSession, source: str | Mapping[str, str], name: str) -> DataFrame:
    """One warehouse table.

    ``source`` is a folder of Parquet tables, or a mapping of JDBC options (``url``, ``driver``,
    and for a parallel read ``partitionColumn``, ``lowerBound``, ``upperBound``,
    ``numPartitions``). Both kinds accept pushed-down filters and column pruning.
    """
    if isinstance(source, str):
        return spark.read.parquet(f"{source}/{name}.parquet")
    return spark.read.format("jdbc").options(**source).option("dbtable", name).load()


def scan_cohort(
    table: DataFrame,
    columns: Sequence[str | Column],
    *,
    where: Column,
) -> DataFrame:
    """Rows of one cohort: an equality or range predicate, then the projection."""
    return table.where(where).select(*columns)


def table_columns(table: DataFrame) -> DataFrame:
    """Position, name and type of each column, with the number of values present."""
    fields = table.schema.fields
    counts = table.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"n{i}") for i, f in enumerate(fields)])
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).cast("long").alias("pos"),
                F.lit(f.name).alias("name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col(f"n{i}").alias("present"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counts.select(F.inline(rows))


def row_parts(table: DataFrame, rows: int = 500_000) -> int:
    """Partitions of at most about ``rows`` rows of a stored table, whose files tell its number of rows."""
    return max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-table.count() // rows))


def packed(df: DataFrame, rows: int, each: int = 500_000) -> DataFrame:
    """``df`` in partitions of about ``each`` of its ``rows`` rows, two a core at least, and no more than it has.

    For small rows that are staged: each partition becomes a file, and where Hadoop has no native library every
    file on a local disk starts two processes from the executor, which weigh as much as itself while they start.
    """
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else one inside the warehouse.

    The warehouse is shared by driver and executors as well; no machine-local folder is made up.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/staged"


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def staged_paths() -> Iterator[list[str]]:
    """Collect the folders that :func:`stage` writes inside the block, for :func:`discard` later on."""
    _LISTENING.append([])
    try:
        yield _LISTENING[-1]
    finally:
        _LISTENING.pop()


def discard(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete staged tables whose results have been written elsewhere; call it when nothing reads them any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several jobs need the same rows: the lineage ends at reliable files, so a lost
    executor costs a re-read and not a recomputation, and columns are still pruned on read. The shuffle
    files of the write are removed once it is done, as nothing reads them again.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    for paths in _LISTENING[-1:]:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)
