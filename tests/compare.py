"""Compare a query with its oracle: columns, types by family, and every value."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, bool) or value is None:
        return value
    return float(value) if isinstance(value, int) else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: only spark {set(df.columns) - set(names)}, only oracle {set(names) - set(df.columns)}"
    got, want = rows_of(df.columns, df.collect()), rows_of(names, cursor.fetchall())
    if got == want:
        return None
    missing, extra = want - got, got - want
    return (
        f"rows spark {sum(got.values())} oracle {sum(want.values())}; missing {sum(missing.values())} "
        f"e.g. {next(iter(missing), None)}; extra {sum(extra.values())} e.g. {next(iter(extra), None)}"
    )
