"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

SPARK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DOUBLE": "double",
}


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def _sorted(rows) -> list:
    return sorted((tuple(map(_plain, row)) for row in rows), key=repr)


def differences(result, connection, sql: str) -> list[str]:
    """Empty when names, types and rows agree."""
    columns = sorted(result.columns)
    described = connection.execute("DESCRIBE " + sql).fetchall()
    types = {name: SPARK_TYPES.get(dtype, dtype) for name, dtype, *_ in described}
    found = []
    if sorted(types) != columns:
        return [f"columns {columns} and {sorted(types)}"]
    if types != dict(result.dtypes):
        found.append(f"types {dict(result.dtypes)} and {types}")
    ours = _sorted(result.select(columns).collect())
    theirs = _sorted(connection.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall())
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows and {len(theirs)}")
    if ours != theirs:
        a, b = set(ours) - set(theirs), set(theirs) - set(ours)
        found.append(f"only here {sorted(a, key=repr)[:2]}, only there {sorted(b, key=repr)[:2]}")
    return found
