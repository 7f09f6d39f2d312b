"""Compare registered queries with their SQL, as the tests and the bench do."""

from __future__ import annotations

import hashlib

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value) -> str:
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return str(value)


def fingerprint(columns: list[str], rows: list[tuple]) -> tuple[list[str], int, str]:
    """Sorted column names, row count and an order-free hash of the values."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_cell(row[i]) for i in order) for row in rows)
    return sorted(columns), len(rows), hashlib.sha256("\x1e".join(lines).encode()).hexdigest()


def spark_result(df) -> tuple[list[str], list[tuple]]:
    return df.columns, [tuple(row) for row in df.collect()]


def sql_result(connection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    return [c[0] for c in cursor.description], cursor.fetchall()
