"""Run registered queries beside their SQL in DuckDB and compare rows without regard to order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return value


def kind(value):
    return type(value).__name__


def rows_of(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


def spark_rows(df):
    return df.columns, rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return columns, rows_of(columns, cur.fetchall())


def difference(left, right):
    (lc, lr), (rc, rr) = left, right
    if sorted(lc) != sorted(rc):
        return f"columns {sorted(lc)} / {sorted(rc)}"
    if len(lr) != len(rr):
        return f"rows {len(lr)} / {len(rr)}"
    for a, b in zip(lr, rr):
        if a != b or [kind(v) for v in a] != [kind(v) for v in b]:
            return f"first difference {a!r:.600} / {b!r:.600}"
    return None
