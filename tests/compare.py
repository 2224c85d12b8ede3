"""Run a registered query and its oracle, and compare the two results as multisets of rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
from collections import Counter

import duckdb


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(os.listdir(sf_dir)):
        if file.endswith(".parquet"):
            con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{sf_dir}/{file}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    return sorted(columns), rows_of(columns, found.fetchall())
