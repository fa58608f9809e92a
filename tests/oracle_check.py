"""Compare a Spark result with DuckDB SQL: names, types, row count and values in any order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{folder}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 9) + 0.0
    return value


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """Reasons why the two results differ; empty when they agree."""
    cursor = con.execute(sql)
    names, kinds = [d[0] for d in cursor.description], [str(d[1]) for d in cursor.description]
    expected = _rows(cursor.fetchall(), names)
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} instead of {sorted(names)}"]
    types = dict(zip(names, kinds, strict=True))
    for field in df.schema.fields:
        if SAME_TYPE.get(field.dataType.simpleString()) != types[field.name]:
            found.append(f"{field.name} is {field.dataType.simpleString()} instead of {types[field.name]}")
    actual = _rows([tuple(r) for r in df.collect()], df.columns)
    if len(actual) != len(expected):
        found.append(f"{len(actual)} rows instead of {len(expected)}")
    elif actual != expected:
        pairs = [(a, e) for a, e in zip(actual, expected, strict=True) if a != e]
        found.append(f"{len(pairs)} rows differ, first {pairs[0]}")
    return found
