"""Run registered queries next to their SQL and compare: ``python -m tests.oracle [names]``."""

from __future__ import annotations

import math
import sys
import tempfile
import time
from collections import Counter
from datetime import date, datetime

import duckdb
from pyspark.sql import SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp_ntz", "TIMESTAMP WITH TIME ZONE": "timestamp",
}


def session(cores: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("vigilo")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, folder, build, sql) -> list[str]:
    """Differences between the two results; empty if they agree."""
    df = build(spark, folder)
    mine = df.collect()
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = [str(c[1]) for c in result.description]
    theirs = result.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    want = dict(zip(names, kinds))
    for name, kind in df.dtypes:
        if TYPES.get(want[name], want[name]) != kind:
            problems.append(f"type of {name}: {kind} != {want[name]}")
    a, b = _bag(df.columns, mine), _bag(names, theirs)
    if a != b:
        problems.append(f"rows {len(mine)} vs {len(theirs)}; {sum((a - b).values())} differ")
        problems.append(f"  columns {sorted(names)}")
        problems += [f"  spark {x}" for x in list((a - b))[:3]] + [f"  sql   {x}" for x in list((b - a))[:3]]
    if not mine:
        problems.append("no rows")
    return problems


def main(wanted: list[str]) -> int:
    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.01"
    if wanted and wanted[0].startswith("/"):
        folder = wanted.pop(0)
    spark, con, failed = session(), database(folder), 0
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in wanted or queries:
        begin = time.monotonic()
        try:
            if name in oracles:
                problems = compare(spark, con, folder, queries[name], oracles[name])
            else:
                n = queries[name](spark, folder).count()
                problems = [] if n else ["no rows"]
        except Exception as error:  # noqa: BLE001 - report and go on
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.monotonic() - begin:.1f}s", *problems, sep="\n     " if problems else " ", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
