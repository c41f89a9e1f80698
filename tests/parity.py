"""Run a registered query on Spark and its reference SQL on DuckDB, and compare all rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = Path(folder) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        raise TypeError("decimal in a result: cast it to double")
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return repr(v)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted(tuple(plain(v) for v in r) for r in df.select(*names).collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.sql(sql)
    names = list(rel.columns)
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted(tuple(plain(r[i]) for i in order) for r in rel.fetchall())
    return [names[i] for i in order], rows


def kind(type_name: str) -> str:
    """Type families that differ in name only."""
    t = str(type_name).upper()
    return {
        "STRING": "VARCHAR", "INT": "INTEGER", "LONG": "BIGINT", "TIMESTAMP_NTZ": "TIMESTAMP",
    }.get(t, t)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    names, mine = spark_rows(df)
    want_names, want = duck_rows(con, sql)
    if names != want_names:
        return f"columns {names} != {want_names}"
    rel = con.sql(sql)
    types = dict(zip(rel.columns, rel.types))
    for f in df.schema:
        if kind(f.dataType.simpleString()) != kind(types[f.name]):
            return f"type of {f.name}: {f.dataType.simpleString()} != {types[f.name]}"
    if len(mine) != len(want):
        return f"{len(mine)} rows != {len(want)}"
    wrong = [(a, b) for a, b in zip(mine, want) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(mine)} rows differ, first: {wrong[0]}"
    return None
