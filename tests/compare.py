"""Run a registered query and its SQL twin, and compare columns, types and every value."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_KINDS = {bool: "boolean", int: "integer", float: "double", str: "text", dt.date: "date"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def _kinds(names, rows) -> dict[str, set]:
    kinds = {name: set() for name in names}
    for row in rows:
        for name, value in zip(names, row):
            if value is not None:
                assert not isinstance(value, Decimal), f"{name} is a decimal"
                kinds[name].add(_KINDS[type(value)])
    return kinds


def differences(df, con, sql: str) -> list[str]:
    names, rows = df.columns, [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    twin_names, twin_rows = [c[0] for c in cursor.description], cursor.fetchall()
    if sorted(names) != sorted(twin_names):
        return [f"columns {sorted(names)} != {sorted(twin_names)}"]
    found = []
    kinds, twin_kinds = _kinds(names, rows), _kinds(twin_names, twin_rows)
    if kinds != twin_kinds:
        found.append(f"types differ: { {n: (kinds[n], twin_kinds[n]) for n in names if kinds[n] != twin_kinds[n]} }")
    ours, theirs = _rows(names, rows), _rows(twin_names, twin_rows)
    if ours != theirs:
        found.append(
            f"{len(rows)} rows against {len(twin_rows)}; columns {sorted(names)}; "
            f"only here {list((ours - theirs).items())[:3]}; only there {list((theirs - ours).items())[:3]}"
        )
    return found
