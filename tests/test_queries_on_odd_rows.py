"""Queries against their SQL on rows that the given tables lack."""

from __future__ import annotations

import duckdb
import pandas as pd

from quillmine.plans import catalogue

from .oracle import mismatch


def test_perplexity_far_from_zero(spark, tmp_path):
    odd = [None, -0.0, -1.5, 499.99999999999994, 500.0, 560.21, -7000.0, -7449.0, -7455.5, -7460.0, -1e5, float("inf"), float("-inf")]
    pd.DataFrame({"event_id": range(len(odd)), "value": odd}).to_parquet(tmp_path / "events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    assert mismatch(spark, con, catalogue.QUERIES["perplexity"], catalogue.ORACLE_SQL["perplexity"], str(tmp_path)) is None
