"""Two-engine check: a registered Spark query against its DuckDB oracle.

Results are compared as sorted multisets of rows with columns in name order,
the way the driver compares them. Only test-sized results are compared here.
"""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, repr(round(v, 6)))
    if hasattr(v, "isoformat"):
        return (1, v.isoformat())
    return (1, repr(v) if not isinstance(v, str) else v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {
        "name": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
    }
    out["values_match"] = out["columns_match"] and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
    if not out["columns_match"]:
        out["spark_cols"] = sorted(set(s_cols) - set(d_cols))
        out["oracle_cols"] = sorted(set(d_cols) - set(s_cols))
    return out
