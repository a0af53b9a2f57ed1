"""Spark result vs. DuckDB SQL twin: row count, column names and values.

Used by the tests and by hand while developing. Values are compared exactly
after sorting rows (floats included), the same strictness as a value hash.
"""

from __future__ import annotations

import datetime as dt
import math

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, repr(float(v)))
    if isinstance(v, bool):
        return (3, str(v))
    if isinstance(v, int):
        return (2, repr(float(v)))
    if isinstance(v, (dt.datetime, dt.date)):
        return (4, v.isoformat())
    return (5, str(v))


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark_df, con, sql: str) -> dict:
    s_cols = list(spark_df.columns)
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    out = {
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "spark_columns": sorted(s_cols),
        "oracle_columns": sorted(d_cols),
    }
    if out["columns_match"]:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        diff = sum(1 for x, y in zip(a, b) if x != y) + abs(len(a) - len(b))
        out["differing_rows"] = diff
        if diff:
            out["first_diff"] = next(((x, y) for x, y in zip(a, b) if x != y), None)
    out["match"] = out["columns_match"] and out["spark_rows"] == out["oracle_rows"] and out.get("differing_rows", 1) == 0
    return out
