"""Run registered queries next to their SQL on the same tables and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            con.execute(f"create view {name[:-8]} as select * from read_parquet('{sf_dir}/{name}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    got = [tuple(_plain(r[i]) for i in order) for r in data]
    return [columns[i] for i in order], sorted(got, key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    cur = con.execute(sql)
    want_cols, want = rows([c[0] for c in cur.description], cur.fetchall())
    got_cols, got = rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"first difference {g} != {w}"
    return None
