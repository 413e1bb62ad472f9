"""Compare a query's rows with its SQL counterpart in DuckDB."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def differences(df, connection, sql: str) -> str | None:
    """None if both give the same columns and the same rows, any order."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    order = sorted(names)
    at = [names.index(n) for n in order]
    expected = Counter(tuple(row[i] for i in at) for row in cursor.fetchall())
    actual = Counter(tuple(row) for row in df.select(*[f"`{n}`" for n in order]).collect())
    if expected == actual:
        return None
    missing, extra = expected - actual, actual - expected
    text = [f"rows: expected {expected.total()}, got {actual.total()}; "
            f"missing {missing.total()}, extra {extra.total()}"]
    for a, b in list(zip(sorted(missing, key=str), sorted(extra, key=str)))[:2]:
        text.append(str({n: (x, y) for n, x, y in zip(order, a, b) if x != y}))
    return "\n".join(text)
