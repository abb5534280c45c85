"""Run a registered query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _value(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        f = float(v)
        return "∅" if math.isnan(f) else (str(int(f)) if f.is_integer() else repr(f))
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_value(r[i]) for i in order) for r in data)


def compare(spark, con, sf, plan, sql):
    """(spark rows, message or None, seconds)"""
    start = time.time()
    df = plan(spark, sf)
    mine = rows(df.columns, df.collect())
    spent = time.time() - start
    if sql is None:
        return len(mine[1]), None, spent
    cur = con.execute(sql)
    theirs = rows([d[0] for d in cur.description], cur.fetchall())
    if mine[0] != theirs[0]:
        return len(mine[1]), f"columns {mine[0]} vs {theirs[0]}", spent
    if mine[1] != theirs[1]:
        a, b = set(mine[1]), set(theirs[1])
        return len(mine[1]), f"{len(mine[1])} vs {len(theirs[1])} rows; only spark {[tuple(x[:90] for x in r) for r in sorted(a - b)[:3]]}; only sql {[tuple(x[:90] for x in r) for r in sorted(b - a)[:3]]}", spent
    return len(mine[1]), None, spent
