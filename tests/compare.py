"""Side-by-side comparison of a Spark result and its SQL counterpart."""

from __future__ import annotations

import decimal
import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

KINDS = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(rows, names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if schemas and rows agree."""
    described = con.execute(f"describe {sql}").fetchall()
    expected_types = {d[0]: d[1] for d in described}
    actual_types = {name: KINDS.get(kind, kind) for name, kind in df.dtypes}
    found = []
    if set(actual_types) != set(expected_types):
        return [f"columns {sorted(set(actual_types) ^ set(expected_types))}"]
    for name in actual_types:
        if actual_types[name] != expected_types[name]:
            found.append(f"type of {name}: {actual_types[name]} / {expected_types[name]}")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(result.fetchall(), names)
    actual = _rows(df.collect(), df.columns)
    if len(actual) != len(expected):
        found.append(f"rows: {len(actual)} / {len(expected)}")
    unequal = [(a, e) for a, e in zip(actual, expected) if a != e]
    if unequal:
        found.append(f"{len(unequal)} unequal rows, first: {unequal[0]}")
    return found
