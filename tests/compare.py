"""Side-by-side run of a registered query and its SQL check."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

from clipstat.plans.standins import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return f"DECIMAL {value}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


DUCK_TYPES = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def differences(spark, con, sf_dir, fn, sql) -> list[str]:
    df = fn(spark, sf_dir)
    got = df.collect()
    cur = con.execute(sql)
    names, types = [d[0] for d in cur.description], [str(d[1]) for d in cur.description]
    want = cur.fetchall()
    notes = []
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a[0] != b[0]:
        return [f"columns {a[0]} != {b[0]}"]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for n, t in zip(names, types):
        if DUCK_TYPES.get(t, t) != kinds[n]:
            notes.append(f"type of {n}: spark {kinds[n]}, sql {t}")
    if len(got) != len(want):
        notes.append(f"rows {len(got)} != {len(want)}")
    if a[1] != b[1]:
        left = sorted(set(a[1]) - set(b[1]))[:3]
        right = sorted(set(b[1]) - set(a[1]))[:3]
        notes.append(f"values differ in {len(set(a[1]) ^ set(b[1]))}: {a[0]}\n   spark {left}\n   sql   {right}")
    return notes
