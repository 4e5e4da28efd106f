"""Order-free comparison of a Spark frame with a DuckDB query."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    """A value with its kind, so that 1, 1.0, True and Decimal(1) differ."""
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, float) and v == 0:
        return ("float", 0.0)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return (type(v).__name__, v.isoformat())
    return (type(v).__name__, v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """None when equal, else a short text saying what differs."""
    cursor = con.execute(sql)
    want_columns = [c[0] for c in cursor.description]
    want_names, want = rows_of(want_columns, cursor.fetchall())
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if got == want:
        return None
    return (
        f"rows {sum(got.values())} vs {sum(want.values())}; "
        f"only spark {list((got - want).elements())[:2]}; only sql {list((want - got).elements())[:2]}"
    )
