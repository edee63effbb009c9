"""Side-by-side check of a registered query against its DuckDB oracle.

Used by the tests and by hand; it mirrors what an external verifier does:
row count, column names, and an order-insensitive comparison of values.
"""

from __future__ import annotations

import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, name: str, sf_dir: str, queries: dict, oracle: dict) -> dict:
    sdf = queries[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = {"query": name, "spark_rows": len(s_rows), "spark_cols": s_cols}
    if name not in oracle:
        res["status"] = "rows-only"
        return res
    con = duckdb_connection(sf_dir)
    cur = con.execute(oracle[name])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res.update(duck_rows=len(d_rows), duck_cols=d_cols)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = "column-mismatch"
    elif len(s_rows) != len(d_rows):
        res["status"] = "count-mismatch"
    elif rows_of(s_cols, s_rows) != rows_of(d_cols, d_rows):
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["status"] = "value-mismatch"
        res["diff"] = [tuple(map(str, d)) for d in diff]
    else:
        res["status"] = "match"
    return res
