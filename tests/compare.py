"""Runs check queries against their SQL in DuckDB and compares rows whatever their order."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import time

import duckdb


def connect(sf_dir):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([plain(r[i]) for i in order] for r in rows)


FAMILIES = {
    "bigint": "int", "int": "int", "double": "float", "string": "text", "date": "date", "boolean": "bool",
    "timestamp_ntz": "timestamp", "timestamp": "timestamp",
    "BIGINT": "int", "INTEGER": "int", "HUGEINT": "huge", "DOUBLE": "float", "VARCHAR": "text", "DATE": "date",
    "BOOLEAN": "bool", "TIMESTAMP": "timestamp",
}


def differences(spark, db, query, sql, sf_dir):
    """Empty when equal, else what differs first; and the Spark seconds."""
    start = time.time()
    df = query(spark, sf_dir)
    got = df.collect()
    seconds = time.time() - start
    expected = db.execute(sql)
    names = [d[0] for d in expected.description]
    kinds = {d[0]: str(d[1]) for d in expected.description}
    ours = dict(df.dtypes)
    want = expected.fetchall()
    if sorted(ours) != sorted(names):
        return f"columns {sorted(ours)} != {sorted(names)}", seconds
    for name, kind in ours.items():
        if FAMILIES.get(kind, kind) != FAMILIES.get(kinds[name], kinds[name]):
            return f"type of {name}: {kind} != {kinds[name]}", seconds
    _, left = table(df.columns, got)
    _, right = table(names, want)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}", seconds
    for a, b in zip(left, right, strict=True):
        if a != b:
            return f"{a} != {b}", seconds
    return "", seconds
