"""Runs a query in Spark and its SQL in DuckDB and compares rows without order."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        c.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path + '/*' if os.path.isdir(path) else glob.escape(path)}')")
    return c


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return f"{float(v):.9g}" if abs(v) < 1 << 53 else str(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return "NULL" if v is None else str(v)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark, function, sql: str, sf_dir: str) -> str:
    """Empty if both agree."""
    df = function(spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    said = connect(sf_dir).sql(sql)
    theirs = rows_of(said.columns, said.fetchall())
    if sorted(df.columns) != sorted(said.columns):
        return f"columns {sorted(df.columns)} and {sorted(said.columns)}"
    if mine != theirs:
        odd = [(a, b) for a, b in zip(mine, theirs) if a != b][:2]
        return f"{len(mine)} and {len(theirs)} rows; {odd}"
    return ""
