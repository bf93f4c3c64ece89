"""Side-by-side comparison of a Spark query with its SQL."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

FAMILY = {
    "tinyint": "int",
    "smallint": "int",
    "integer": "int",
    "int": "int",
    "hugeint": "huge",
    "string": "text",
    "varchar": "text",
    "timestamp": "time",
    "timestamp_ntz": "time",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences between the two results; empty when they agree."""
    relation = con.sql(sql)
    spark_types = {n: FAMILY.get(t, t) for n, t in df.dtypes}
    duck_types = {
        n: FAMILY.get(str(t).lower(), str(t).lower())
        for n, t in zip(relation.columns, relation.types)
    }
    problems = []
    if spark_types != duck_types:
        problems.append(f"schema {spark_types} / {duck_types}")
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _rows(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} / {len(theirs)}")
    elif ours != theirs:
        bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
        problems.append(f"{len(bad)} of {len(ours)} rows differ, first {bad[0]}")
    return problems
