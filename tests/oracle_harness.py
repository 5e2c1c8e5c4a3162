"""Spark-vs-DuckDB comparison used by the oracle tests and ``check_oracle.py``.

Mirrors the driver's gate: same row count, same column names, and the same
multiset of rows after normalising values (floats compared at 1e-6 relative).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

# ORACLE_EXACT=1 compares floats bit for bit instead of at 6 significant digits.
EXACT = os.environ.get("ORACLE_EXACT") == "1"

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if EXACT else float(f"{v:.6g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.6g}")
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "toArray"):
        return tuple(_norm(float(x)) for x in v.toArray())
    return str(v)


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    return cols, sorted(rows, key=_key)


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    rows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    return cols, sorted(rows, key=_key)


def suspicious_types(con, sql) -> list[str]:
    """Oracle columns whose DuckDB type has no Spark counterpart in our outputs
    (DECIMAL from literals like 1.0, HUGEINT from some integer aggregates)."""
    rel = con.sql(sql)
    return [f"{c}:{t}" for c, t in zip(rel.columns, rel.types) if "DECIMAL" in str(t) or "HUGEINT" in str(t)]


def compare(df, con, sql) -> tuple[bool, str]:
    odd = suspicious_types(con, sql)
    if odd:
        return False, f"oracle column types to cast: {odd}"
    scols, srows = spark_rows(df)
    dcols, drows = duck_rows(con, sql)
    if scols != dcols:
        return False, f"columns differ: spark={scols} duck={dcols}"
    if len(srows) != len(drows):
        return False, f"row count differs: spark={len(srows)} duck={len(drows)}"
    for a, b in zip(srows, drows):
        if a != b:
            return False, f"first differing row:\n spark={a}\n duck ={b}\n cols={scols}"
    return True, f"{len(srows)} rows equal"
