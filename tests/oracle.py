"""Spark result against the DuckDB text of the same query, by sorted value."""

from __future__ import annotations

import math
import os

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


# Spark type name -> DuckDB type name
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
         "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences, empty when both sides agree."""
    rel = con.sql(sql)
    names = list(rel.columns)
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    theirs = {d[0]: d[1] for d in con.sql(f"DESCRIBE {sql}").fetchall()}
    typed = [f"type of {n}: {t} / {theirs[n]}" for n, t in df.dtypes if TYPES.get(t) != theirs[n]]
    if typed:
        return typed
    left = _rows(df.columns, [tuple(r) for r in df.collect()])
    right = _rows(names, rel.fetchall())
    if len(left) != len(right):
        return [f"rows {len(left)} != {len(right)}", f"{left[:2]}", f"{right[:2]}"]
    return [f"{a}\n   != {b}" for a, b in zip(left, right) if a != b][:3]
