"""Compare a Spark query with its DuckDB twin, row order aside."""

from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def mismatch(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    got = spark_df.collect()
    rel = con.execute(sql)
    want_names = [d[0] for d in rel.description]
    want = rel.fetchall()
    if sorted(spark_df.columns) != sorted(want_names):
        return f"columns {sorted(spark_df.columns)} vs {sorted(want_names)}"
    a, b = _rows(spark_df.columns, got), _rows(want_names, want)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y or [type(v) for v in x] != [type(v) for v in y]]
    if bad:
        names = sorted(want_names)
        x, y = bad[0]
        diff = {n: (p, q) for n, p, q in zip(names, x, y) if p != q or type(p) is not type(q)}
        return f"{len(bad)} of {len(a)} rows differ, first: {diff} row {x[:6]}"
    return None
