"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _kind(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    return type(value).__name__


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    kinds = {}
    for row in rows:
        for i in order:
            if row[i] is not None:
                kinds.setdefault(names[i], set()).add(_kind(row[i]))
    plain = sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)
    return [names[i] for i in order], kinds, plain


def differences(df, con, sql: str) -> str | None:
    found = con.execute(sql)
    expected = rows_of([c[0] for c in found.description], found.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if actual[0] != expected[0]:
        return f"columns {actual[0]} / {expected[0]}"
    if len(actual[2]) != len(expected[2]):
        return f"rows {len(actual[2])} / {len(expected[2])}"
    if actual[1] != expected[1]:
        return f"types {actual[1]} / {expected[1]}"
    for a, b in zip(actual[2], expected[2]):
        if a != b:
            return f"values\n  {a}\n  {b}"
    return None if actual[2] else "no rows"
