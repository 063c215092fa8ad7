"""Comparing a DataFrame with rows from elsewhere."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from pathlib import Path

SF_DIR = "/root/testdata/sf0.001"
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(df, columns=None):
    """A DataFrame's rows as a multiset, columns in a stated or sorted order."""
    columns = columns or sorted(df.columns)
    return Counter(tuple(_plain(v) for v in row) for row in df.select(*columns).collect())


def oracle_rows(sql: str, sf_dir: str):
    """Column names, types and rows DuckDB gives for a query."""
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    types = {row[0]: row[1] for row in described}
    columns = sorted(types)
    listed = ", ".join(f'"{c}"' for c in columns)
    rows = con.execute(f"SELECT {listed} FROM ({sql})").fetchall()
    return types, Counter(tuple(_plain(v) for v in row) for row in rows)
