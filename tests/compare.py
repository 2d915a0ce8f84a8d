"""Compare a query with its DuckDB SQL on the same tables."""

from __future__ import annotations

import glob
import os

import duckdb
import numpy as np
import pandas as pd


def views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return c


def plain(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    text = df.apply(lambda s: s.map(lambda v: "null" if v is None or v is pd.NaT or (isinstance(v, float) and np.isnan(v)) else str(int(v)) if isinstance(v, float) and v == int(v) else str(v)))
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    g, w = plain(got), plain(want)
    if len(g) != len(w):
        return f"{len(g)} and {len(w)} rows"
    bad = (g != w).any(axis=1)
    return "" if not bad.any() else f"{int(bad.sum())} of {len(g)} rows differ, first:\n{g[bad].head(2)}\n{w[bad].head(2)}"
