"""Runs a query and its SQL side by side and compares columns, counts and values."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        files = sorted(glob.glob(f"{path}/*.parquet")) if os.path.isdir(path) else [path]
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet({files})")
    return c


def canonical(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)

    def one(v):
        if v is None or (isinstance(v, float) and v != v) or v is pd.NA:
            return "NULL"
        return f"{float(v):.6g}" if isinstance(v, float) else str(v)

    return sorted(tuple(one(v) for v in r) for r in df[cols].astype(object).itertuples(index=False))


def difference(spark, sf_dir: str, query, sql: str) -> str | None:
    got, want = query(spark, sf_dir).toPandas(), connect(sf_dir).sql(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if len(a) != len(b):
        return f"{len(a)} rows and {len(b)}"
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    return f"{len(bad)} of {len(a)} rows differ: {str(bad[0])[:600]}" if bad else None
