"""Compare a Spark result with the rows DuckDB gives, order aside."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        files = path / "*.parquet" if path.is_dir() else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def assert_same(frame, con, sql: str) -> int:
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    expected = found.fetchall()
    assert sorted(frame.columns) == sorted(names)
    rows = [tuple(r) for r in frame.collect()]
    got, want = bag(frame.columns, rows), bag(names, expected)
    assert got == want, f"missing {list((want - got).items())[:3]}, extra {list((got - want).items())[:3]}"
    return len(rows)
