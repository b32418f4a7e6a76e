"""Side-by-side comparison of a query and its SQL twin."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def rows_of(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(picked, key=repr)


def difference(df, connection, sql: str) -> str | None:
    """None when names, types, row count and all values agree exactly."""
    relation = connection.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} against {sorted(relation.columns)}"
    kinds = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "string": "VARCHAR",
        "date": "DATE",
        "boolean": "BOOLEAN",
    }
    ours = {f.name: kinds[f.dataType.simpleString()] for f in df.schema.fields}
    theirs = dict(zip(relation.columns, map(str, relation.types), strict=True))
    if ours != theirs:
        return f"types {ours} against {theirs}"
    left = rows_of(df.columns, df.collect())
    right = rows_of(relation.columns, relation.fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    unequal = [(a, b) for a, b in zip(left, right, strict=True) if a != b]
    return f"{len(unequal)} rows differ, first {unequal[0]}" if unequal else None
