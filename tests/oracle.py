"""Runs a query and its DuckDB SQL over the same tables."""

import math

import duckdb

from quirekit.session import TABLES


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(_plain, v)) + "]"
    return repr(v)


def both(spark, sf, query, sql):
    df = query(spark, sf)
    cols = sorted(df.columns)
    ours = sorted(tuple(_plain(r[c]) for c in cols) for r in df.collect())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    rel = con.sql(sql)
    theirs = sorted(tuple(map(_plain, r)) for r in rel.select(*[f'"{c}"' for c in sorted(rel.columns)]).fetchall())
    return cols, sorted(rel.columns), ours, theirs
