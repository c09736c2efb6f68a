"""Side-by-side check of a query and its SQL twin, as the driver does it."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

from goldleaf.sources.testbed import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _value(value):
    if isinstance(value, dt.datetime) and value.time() == dt.time(0):
        return value.date().isoformat()
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, int):
        return repr(float(value))
    return str(value)


def normal_rows(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_value(r[i]) for i in order) for r in rows)


def twin_rows(con: duckdb.DuckDBPyConnection, sql: str):
    result = con.execute(sql)
    return normal_rows([d[0] for d in result.description], result.fetchall())


def spark_rows(df):
    return normal_rows(df.columns, [tuple(r) for r in df.collect()])
