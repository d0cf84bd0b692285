"""Runs a query and its SQL side by side over one folder of tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def comparable(frame) -> list[tuple]:
    names = sorted(frame.columns)

    def plain(v):
        if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and v != v:
            return None
        v = v.item() if hasattr(v, "item") else v
        return int(v) if isinstance(v, float) and v == int(v if abs(v) < 1e300 else 0) else v

    return sorted((tuple(plain(v) for v in row) for row in frame[names].astype(object).itertuples(index=False)), key=repr)


def mismatch(spark, con, query, sql: str, sf_dir: str) -> str | None:
    got, want = query(spark, sf_dir).toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    a, b = comparable(got), comparable(want)
    if len(a) != len(b):
        return f"{len(a)} and {len(b)} rows"
    return next((f"{x} and {y}" for x, y in zip(a, b) if x != y), None)
