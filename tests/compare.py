"""Strict comparison of a Spark result with its SQL check run by DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TYPES = {
    "tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT",
    "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 9) + 0.0
    return value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is not None, str(v)) for v in r))


def differences(df, sql: str, con: duckdb.DuckDBPyConnection) -> list[str]:
    """Empty when row count, column names, types and values agree."""
    relation = con.sql(sql)
    expected_types = dict(zip(relation.columns, [str(t) for t in relation.types]))
    actual_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    problems = []
    if expected_types != actual_types:
        odd = {k: (actual_types.get(k), expected_types.get(k)) for k in {*expected_types, *actual_types}
               if actual_types.get(k) != expected_types.get(k)}
        problems.append(f"types (spark, sql): {odd}")
    if set(expected_types) != set(actual_types):
        return problems
    expected = _sorted_rows(relation.columns, relation.fetchall())
    actual = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if len(expected) != len(actual):
        problems.append(f"rows: spark {len(actual)}, sql {len(expected)}")
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first (spark, sql): {wrong[0]}")
    if not actual:
        problems.append("no rows")
    return problems
