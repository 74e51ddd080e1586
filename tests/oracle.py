"""Compare a registered Spark query with its DuckDB oracle, the way the driver's gate does (order-insensitive)."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    return v


def rows_of(df: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(None if (not isinstance(x, (list, tuple)) and not hasattr(x, "__len__") and pd.isna(x)
                                        and not (isinstance(x, float) and math.isnan(x))) else x) for x in rec))
    out.sort(key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))
    return cols, out


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> str | None:
    """None when equal, else a short description of the first difference."""
    sc, sr = rows_of(spark_pdf)
    dc, dr = rows_of(duck_pdf)
    if sc != dc:
        return f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return f"row count differs: spark={len(sr)} duck={len(dr)}"
    for a, b in zip(sr, dr):
        if a != b:
            return f"first differing row: spark={a} duck={b}"
    return None
