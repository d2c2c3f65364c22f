"""Run a query in Spark and its counterpart in DuckDB and compare the results."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(directory: str):
    con = duckdb.connect()
    for table in TABLES:
        path = Path(directory) / f"{table}.parquet"
        files = path / "*.parquet" if path.is_dir() else path
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{files}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return repr(value) if isinstance(value, bool) else str(value)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def difference(df, con, sql: str) -> str | None:
    """None if both sides agree in columns, types and values."""
    cursor = con.execute(sql)
    theirs_types = {d[0]: str(d[1]) for d in cursor.description}
    theirs = cursor.fetchall()
    ours_types = {name: KINDS.get(kind, kind) for name, kind in df.dtypes}
    if ours_types != theirs_types:
        wrong = {k: (ours_types.get(k), theirs_types.get(k))
                 for k in ours_types.keys() | theirs_types.keys()
                 if ours_types.get(k) != theirs_types.get(k)}
        return f"columns differ (spark, duckdb): {wrong}"
    a = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    b = _sorted_rows(list(theirs_types), theirs)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}" if bad else None
