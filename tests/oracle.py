"""Compare registered queries with their SQL in DuckDB."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    made = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(made, key=repr)


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when both give the same column names and the same bag of rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    got = _rows(spark_df.columns, spark_df.collect())
    problems = []
    if sorted(names) != sorted(spark_df.columns):
        problems.append(f"columns {sorted(spark_df.columns)} != {sorted(names)}")
    if len(got) != len(expected):
        problems.append(f"rows {len(got)} != {len(expected)}")
    pairs = [(g, e) for g, e in zip(got, expected) if g != e]
    if pairs and not problems:
        problems.append(f"{len(pairs)} rows differ, first {str(pairs[0])[:600]}")
    return problems
