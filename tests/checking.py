"""Compare a registered query with its SQL equivalent, value by value."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else repr(value + 0.0))
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, datetime.datetime | datetime.date):
        return (type(value).__name__, value.isoformat())
    if isinstance(value, list | tuple):
        return tuple(_cell(v) for v in value)
    return repr(value)


def spark_rows(df) -> tuple[list[str], Counter]:
    columns = sorted(df.columns)
    return columns, Counter(tuple(_cell(r[c]) for c in columns) for r in df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(_cell(r[i]) for i in order) for r in cursor.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None if equal, else a short description."""
    columns, ours = spark_rows(df)
    names, theirs = duck_rows(con, sql)
    if columns != names:
        return f"columns {columns} != {names}"
    if ours == theirs:
        return None
    extra, missing = ours - theirs, theirs - ours
    return (f"{sum(ours.values())} rows against {sum(theirs.values())}; {sum(extra.values())} extra, {sum(missing.values())} missing; "
            f"extra {list(extra)[:2]} missing {list(missing)[:2]}")[:900]
