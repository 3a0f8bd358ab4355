"""Differential check: a query's rows against its SQL in DuckDB on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in sorted(Path(root).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        v = round(v, 6)
        return int(v) if v.is_integer() else v
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None).isoformat() if v.tzinfo is None else v.tz_convert("UTC").tz_localize(None).isoformat()
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return tuple(plain(x) for x in v)
    return v


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    return sorted((tuple(plain(v) for v in r) for r in df[cols].astype(object).itertuples(index=False)), key=lambda r: tuple((x is not None, str(x)) for x in r))


def differences(spark_df, con, sql: str, show: int = 3) -> str:
    """Empty if the results agree."""
    got, want = spark_df.toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    a, b = rows(got), rows(want)
    if a == b:
        return ""
    sa, sb = set(a), set(b)
    return f"{len(a)} and {len(b)} rows; only here {sorted(sa - sb, key=str)[:show]}; only in SQL {sorted(sb - sa, key=str)[:show]}"
