"""Compare a query with its SQL: same columns, same rows whatever their order."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r)
    )


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a description of the first difference."""
    found = df.collect()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours, theirs = rows_of(df.columns, found), rows_of(names, expected)
    if len(ours) != len(theirs):
        extra, lacking = list(set(ours) - set(theirs))[:2], list(set(theirs) - set(ours))[:2]
        return f"{len(ours)} rows != {len(theirs)}; only here {extra}; only there {lacking}"
    wrong = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(ours)} rows differ ({sorted(names)}): {wrong[0][0]} != {wrong[0][1]}"
    return None
