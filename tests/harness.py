"""Run a registered query in Spark and its DuckDB oracle; compare results."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat() + " 00:00:00"
    return v


def _close(a, b, rel=1e-9) -> bool:
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, (float, Decimal, int)) and isinstance(b, (float, Decimal, int)):
        if isinstance(a, float) or isinstance(b, float):
            fa, fb = float(a), float(b)
            return fa == fb or abs(fa - fb) <= rel * max(abs(fa), abs(fb), 1e-300)
        return Decimal(a) == Decimal(b)
    return a == b


def _key(row):
    return tuple((0, "") if v is None else (1, str(v)) for v in row)


def compare(spark_df, con, sql: str, rel: float = 1e-9):
    """Return (ok, message).  Columns are matched by name, rows order-free."""
    s_cols = spark_df.columns
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_raw = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    idx = [d_cols.index(c) for c in sorted(s_cols)]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in d_raw]
    if len(s_rows) != len(d_rows):
        return False, f"row counts differ: spark={len(s_rows)} duck={len(d_rows)}"
    s_sorted = sorted(s_rows, key=_key)
    d_sorted = sorted(d_rows, key=_key)
    exact = True
    inexact = []
    for a, b in zip(s_sorted, d_sorted):
        for c, x, y in zip(sorted(s_cols), a, b):
            if not _close(x, y, rel):
                return False, f"value differs in {c}: spark={x!r} duck={y!r}\n spark row={a}\n duck row={b}"
            if x != y and not (isinstance(x, (float, Decimal)) and float(x) == float(y)):
                exact = False
                inexact.append((c, x, y))
    return True, "ok" + ("" if exact else f" ({len(inexact)} floats within tolerance, e.g. {inexact[:2]})")
