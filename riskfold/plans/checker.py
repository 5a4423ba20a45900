"""Local side-by-side check: Spark query vs DuckDB oracle (the driver's gate).

Compares row count, column names and an order-insensitive hash of the values
after sorting columns by name.  Used by tests and while developing.
"""

from __future__ import annotations

import hashlib
import math

import duckdb
import pandas as pd

from riskfold.sources.tables import TABLES, table_path


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else v
    if hasattr(v, "item"):
        return _norm(v.item())
    if v is pd.NA or v is pd.NaT:
        return None
    return v


def frame_digest(pdf: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        rows.append(repr(tuple(_norm(v) for v in rec)))
    rows.sort()
    h = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return len(pdf), cols, h


def compare(spark_df, sql: str, con) -> dict:
    sp = spark_df.toPandas()
    dk = con.sql(sql).df()
    a, b = frame_digest(sp), frame_digest(dk)
    out = {"rows": (a[0], b[0]), "cols_match": a[1] == b[1], "hash_match": a[2] == b[2]}
    if not out["cols_match"]:
        out["cols_only_spark"] = sorted(set(a[1]) - set(b[1]))
        out["cols_only_oracle"] = sorted(set(b[1]) - set(a[1]))
    elif not out["hash_match"] and a[0] == b[0]:
        # locate the first differing column for debugging
        key = a[1]
        s = sp[key].map(lambda x: x).astype(object).apply(lambda c: c.map(_norm))
        d = dk[key].astype(object).apply(lambda c: c.map(_norm))
        s = s.sort_values(key, na_position="first").reset_index(drop=True)
        d = d.sort_values(key, na_position="first").reset_index(drop=True)
        diffs = [c for c in key if not s[c].equals(d[c])]
        out["diff_cols"] = diffs[:10]
    return out
