"""Compare a query with its DuckDB equivalent, ignoring row and column order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(data_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data_dir}/{name}.parquet')"
        )
    return connection


def _value(value):
    if isinstance(value, float) and not math.isnan(value):
        return float(f"{value:.12g}")
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_value(row[i]) for i in order) for row in rows]
    return sorted(picked, key=lambda row: [(v is None, str(type(v)), str(v)) for v in row])


def spark_rows(df):
    return sorted(df.columns), _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(connection, sql):
    cursor = connection.execute(sql)
    columns = [c[0] for c in cursor.description]
    return sorted(columns), _sorted_rows(columns, cursor.fetchall())


_INT_BITS = {"TINYINT": 8, "SMALLINT": 16, "INTEGER": 32, "BIGINT": 64, "HUGEINT": 128}
_SPARK_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def type_differences(df, connection, sql) -> dict[str, tuple[str, str]]:
    """Columns whose DuckDB type is not the one of the Spark column."""
    described = {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
    return {
        name: (kind, described.get(name))
        for name, kind in df.dtypes
        if _SPARK_TYPES.get(kind, kind) != described.get(name)
    }
