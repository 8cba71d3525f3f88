"""Compare a Spark result with the result of its SQL equivalent in DuckDB."""

from __future__ import annotations

import datetime
import decimal
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, int):
        return f"int {value}"
    if isinstance(value, float):
        return f"float {value!r}"
    if isinstance(value, (datetime.datetime, datetime.date)):
        return f"{type(value).__name__} {value.isoformat()}"
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when columns, types and values agree, else what does not."""
    result = con.execute(sql)
    expected_columns, expected = _rows([c[0] for c in result.description], result.fetchall())
    columns, actual = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return "values differ: " + "; ".join(
                f"{c}: {x} != {y}" for c, x, y in zip(columns, a, e) if x != y)
    return None
