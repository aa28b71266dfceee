"""Side-by-side check of a catalogue query against its DuckDB oracle.

Mirrors the driver's gate: same column names, same row count and the same
order-insensitive multiset of rows (columns sorted by name).  Values are
compared exactly; a tolerant pass (doubles to 9 significant digits) is
reported too, to tell real bugs from last-bit noise.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
from collections import Counter

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_connection(sf_dir: str):
    import os

    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v, tolerant: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}") if tolerant else v
    if isinstance(v, decimal.Decimal):
        return float(v) if not tolerant else float(f"{float(v):.9g}")
    if isinstance(v, _dt.datetime):
        return v.isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, tolerant) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item(), tolerant)
    return v


def _rows(cols, records, tolerant):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i], tolerant) for i in order) for r in records)


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    # a view, as the driver makes: SQL that needs rows of this process fails
    con.execute(f"CREATE OR REPLACE TEMP VIEW checked AS {sql}")
    rel = con.sql("SELECT * FROM checked")
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    out = {
        "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "spark_only_cols": sorted(set(s_cols) - set(d_cols)),
        "oracle_only_cols": sorted(set(d_cols) - set(s_cols)),
    }
    if out["columns_match"]:
        out["exact"] = _rows(s_cols, s_rows, False) == _rows(d_cols, d_rows, False)
        out["tolerant"] = _rows(s_cols, s_rows, True) == _rows(d_cols, d_rows, True)
        if not out["tolerant"]:
            a, b = _rows(s_cols, s_rows, True), _rows(d_cols, d_rows, True)
            out["spark_minus_oracle"] = list((a - b).elements())[:3]
            out["oracle_minus_spark"] = list((b - a).elements())[:3]
            out["sorted_cols"] = sorted(s_cols)
    else:
        out["exact"] = out["tolerant"] = False
    return out
