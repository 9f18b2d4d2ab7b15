"""Run a registered query and its SQL twin and compare them row by row."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

FAMILY = {
    "tinyint": "int", "smallint": "int", "integer": "int", "int": "int", "bigint": "int", "hugeint": "huge",
    "double": "double", "float": "double", "boolean": "bool", "varchar": "text", "string": "text",
    "date": "date", "timestamp": "ts", "timestamp_ntz": "ts",
}


def database(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None when names, types and the bag of rows agree; else what differs."""
    cursor = con.execute(sql)
    expected_types = {d[0]: FAMILY.get(str(d[1]).lower(), str(d[1])) for d in cursor.description}
    names = [d[0] for d in cursor.description]
    expected = _bag(names, cursor.fetchall())
    types = {n: FAMILY.get(t, t) for n, t in df.dtypes}
    if types != expected_types:
        return f"columns: {sorted(types.items())} against {sorted(expected_types.items())}"
    found = _bag(df.columns, [tuple(r) for r in df.collect()])
    if found != expected:
        return f"only Spark {list((found - expected).items())[:3]}, only SQL {list((expected - found).items())[:3]}"
    return None
