"""Compares a Spark result with DuckDB, ignoring row and column order."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from slotstream.testdata import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value: object) -> object:
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, float):
        return round(value, 9)
    return value


def bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    found = [tuple(row) for row in df.collect()]
    relation = con.sql(sql)
    wanted = relation.fetchall()
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    ours, theirs = bag(df.columns, found), bag(list(relation.columns), wanted)
    if ours == theirs:
        return None
    return (
        f"{len(found)} rows against {len(wanted)}; only ours {list((ours - theirs).items())[:3]}; "
        f"only oracle {list((theirs - ours).items())[:3]}; columns {sorted(df.columns)}"
    )
