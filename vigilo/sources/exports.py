"""CSV export and re-import of risk records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_export(df: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> None:
    """Unquoted CSV with a header; missing values become empty strings.

    The format has no quoting, so commas and line breaks inside text are replaced by a space.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    clean = df.withColumns({c: F.regexp_replace(c, r"[,\r\n]+", " ") for c in text}) if text else df
    writer = clean.write.mode("errorifexists").options(
        header=True, nullValue="", emptyValue="", quote="", timestampFormat="yyyy-MM-dd HH:mm:ss"
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All export files below ``path`` stacked, in the given column order."""
    df = (
        spark.read.schema(schema)
        .options(header=True, nullValue="", quote="", timestampFormat="yyyy-MM-dd HH:mm:ss",
                 enforceSchema=True)
        .csv(path)
    )
    return df.select(*schema.fieldNames())
