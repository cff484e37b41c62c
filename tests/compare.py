"""Run a registered query and its SQL side by side and describe the first difference."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return repr(v)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


SPARK_TO_SQL = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT",
}


def difference(df, con, sql: str) -> str | None:
    got_cols, got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want_cols, want = sorted_rows(names, cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    mine = {f.name: SPARK_TO_SQL.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    odd = {n: (mine[n], kinds[n]) for n in mine if mine[n] != kinds[n]}
    if odd:
        return f"types {odd}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{len(set(got) ^ set(want))} rows differ, first {dict(zip(got_cols, g))} != {dict(zip(got_cols, w))}"
    return None
