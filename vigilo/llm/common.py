"""Helpers shared by the operators: tables, packed arrays, and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.sources.tables import packed, stage

EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id: str, folds: int, fold: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; an id that is null is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """So many rows go to Python at a time, where a row is some megabytes; holds for what is written inside the block."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links ``a[i]``-``b[i]``, each with the smallest node it reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
        if (low == high).all():
            return nodes, nodes[root]
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]


def _contract(batches):
    """Links of one partition, a few batches at a time, as links to the smallest node reached."""
    import pyarrow as pa

    for batch in batches:
        a, b = (np.asarray(batch.column(k), dtype=np.int64) for k in (0, 1))
        if len(a):
            node, low = forest(a, b)
            keep = node != low
            yield pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(low[keep])], names=["u", "v"])


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for each node that has a link.

    Alternating large and small stars: every round hangs the larger neighbours of a node, then the
    smaller ones, on its smallest neighbour. Each round is written to the shared folder, so its
    lineage is short and survives lost executors; its files are as many as the links need. Links of one
    batch are contracted beforehand. ``links`` are counted first, so they should be staged.
    """
    pairs = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = pairs.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    edges = stage(packed(edges.mapInArrow(_contract, "u long, v long").distinct(), pairs.count()), "edges")
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(now) == mark or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = tuple(now)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(low, "u")
        small = met.select("u", F.col("m").alias("v")).union(
            met.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        edges = stage(packed(small, now[0]), "edges")


def text_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null is empty."""
    import pyarrow as pa

    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def spread(df: DataFrame, by: str) -> DataFrame:
    """Rows dealt evenly by a key that is nearly unique, before costly work on few large rows."""
    return df.repartition(max(shuffle_parts(df.sparkSession), 1), F.col(by))
