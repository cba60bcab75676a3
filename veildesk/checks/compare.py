"""Run registered queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

from veildesk.checks.tables import GIVEN


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df: DataFrame):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str):
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both sides give the same rows, else a short description."""
    (names, ours), (other_names, theirs) = spark_rows(df), duck_rows(con, sql)
    if names != other_names:
        return f"columns {names} != {other_names}"
    if ours == theirs:
        return None
    left, right = set(map(repr, ours)), set(map(repr, theirs))
    return (
        f"rows {len(ours)} != {len(theirs)}; only Spark: {sorted(left - right)[:3]}; "
        f"only SQL: {sorted(right - left)[:3]}"
    )[:3000]
