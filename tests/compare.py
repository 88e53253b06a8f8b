"""Order-insensitive comparison of a Spark result with a DuckDB result, columns sorted by name."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_canon(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _canon(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _canon(v.asDict())
    return v


def canon_rows(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_canon(r[i]) for i in order) for r in rows]
    out.sort(key=repr)
    return [names[i] for i in order], out


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[bool, str]:
    s_names, s_rows = canon_rows(spark_df.columns, spark_df.collect())
    res = con.execute(sql)
    d_names = [c[0] for c in res.description]
    d_names, d_rows = canon_rows(d_names, res.fetchall())
    if s_names != d_names:
        return False, f"columns differ: spark={s_names} duck={d_names}"
    if len(s_rows) != len(d_rows):
        return False, f"row counts differ: spark={len(s_rows)} duck={len(d_rows)}"
    for a, b in zip(s_rows, d_rows):
        if a != b:
            return False, f"first differing row: spark={a} duck={b}"
    return True, f"{len(s_rows)} rows match"
