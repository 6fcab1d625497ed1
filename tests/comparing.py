"""Compares a Spark result with the rows another engine gives for the same query."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((False, str(type(v)), v) if v is not None else (True, "", 0) for v in r))


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def differences(result, connection, sql: str) -> list[str]:
    """What differs between a DataFrame and the SQL's rows: names, types, count, values."""
    relation = connection.sql(sql)
    names, expected_names = result.columns, relation.columns
    if sorted(names) != sorted(expected_names):
        return [f"columns {sorted(names)} against {sorted(expected_names)}"]
    found = []
    theirs = dict(zip(expected_names, [str(t) for t in relation.types]))
    for name, kind in result.dtypes:
        if KINDS.get(kind, kind) != theirs[name]:
            found.append(f"type of {name}: {kind} against {theirs[name]}")
    ours = sorted_rows(names, [tuple(r) for r in result.collect()])
    wanted = sorted_rows(expected_names, relation.fetchall())
    if len(ours) != len(wanted):
        found.append(f"{len(ours)} rows against {len(wanted)}")
    different = [(a, b) for a, b in zip(ours, wanted) if a != b]
    if different:
        found.append(f"{len(different)} rows differ, first {different[0]}")
    return found
