"""Order-insensitive comparison of a Spark result with a DuckDB answer."""

from __future__ import annotations

import decimal
import math


EXACT = False


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else (v if EXACT else round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        return norm(v.item())
    return v


def rows_of(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark_df, duck_con, sql: str) -> list[str]:
    """Problems found (empty when the results agree)."""
    s_cols = spark_df.columns
    s_rows = rows_of([tuple(r) for r in spark_df.collect()], s_cols)
    res = duck_con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = rows_of(res.fetchall(), d_cols)
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} duck={sorted(d_cols)}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    elif s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems


def duck_views(sf_dir: str, tables):
    import duckdb

    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con
