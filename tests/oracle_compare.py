"""Compare a Spark result with DuckDB SQL: row count, column names, values."""

from __future__ import annotations

import math


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)) if x is not None else "", x if x is not None else 0) for x in row)


def compare(spark_df, con, sql):
    s_cols = list(spark_df.columns)
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    s_rows = [tuple(r) for r in spark_df.collect()]
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={s_cols} duckdb={d_cols}")
        return problems
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    s_vals = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=_key)
    d_vals = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=_key)
    if len(s_vals) != len(d_vals):
        problems.append(f"row count differs: spark={len(s_vals)} duckdb={len(d_vals)}")
    for a, b in zip(s_vals, d_vals):
        if a != b:
            problems.append(f"first differing row:\n spark ={a!r:.600}\n duckdb={b!r:.600}")
            break
    return problems
