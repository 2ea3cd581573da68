"""Run a registered query next to its SQL and compare rows as multisets."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return ("ts", value.replace(tzinfo=None))
    if isinstance(value, dt.date):
        return ("date", value)
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(normal(r[n]) for n in names) for r in df.collect())


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    return names, Counter(tuple(normal(r[i]) for i in order) for r in cursor.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    have_names, have = spark_rows(df)
    want_names, want = sql_rows(con, sql)
    if have_names != want_names:
        return f"columns {have_names} != {want_names}"
    if have == want:
        return None
    extra, missing = have - want, want - have
    return (
        f"{sum(have.values())} rows against {sum(want.values())}; "
        f"not in SQL: {list(extra.items())[:2]}; only in SQL: {list(missing.items())[:2]}"
    )
