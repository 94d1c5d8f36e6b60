"""Adding group statistics to rows without moving the rows.

Tables of groups are written down before they join: Spark then knows their bytes when it plans the join and
broadcasts them if they are few. Of an aggregate it assumes the size of its input, and would shuffle the rows
by a handful of groups first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.sources.tables import stage


def table_stats(df: DataFrame, stats: dict[str, Column]) -> dict[str, Column]:
    """Aggregates of the whole table as constants.

    They are one row, computed once here; operators that need several of them in turn would
    otherwise nest the table into itself as subqueries again and again.
    """
    frame = df.agg(*[c.alias(n) for n, c in stats.items()])
    row = frame.first()
    return {f.name: F.lit(row[f.name]).cast(f.dataType) for f in frame.schema.fields}


def join_groups(df: DataFrame, table: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a table of groups on its keys; missing keys match each other, keys appear once.

    The keys of ``table`` are renamed first, so both sides may stem from the same DataFrame.
    """
    renamed = table.select(
        *[F.col(c).alias(f"__k_{c}") for c in by], *[c for c in table.columns if c not in by]
    )
    cond = [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in by]
    return df.join(renamed, cond, how).drop(*[f"__k_{c}" for c in by])


def with_group_stats(df: DataFrame, by: Sequence[str], stats: dict[str, Column]) -> DataFrame:
    """Add aggregates of the row's group; without ``by`` of the whole table.

    Table-wide values enter as constants. Group values are written down and join on their keys; a missing
    group value is a group of its own.
    """
    if not by:
        return df.withColumns(table_stats(df, stats))
    table = df.groupBy(*by).agg(*[c.alias(n) for n, c in stats.items()])
    return join_groups(df, stage(table, "groups"), by, "left")
