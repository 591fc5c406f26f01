"""Order-free comparison of a Spark frame with a DuckDB result."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def differences(df, con, sql) -> str:
    """Empty when names, kinds and rows agree; else a short account of what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    want = rows_of(names, cursor.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    off = {c: (t, kinds[c]) for c, t in df.dtypes if same.get(t) != kinds[c]}
    if off:
        return f"types {off}"
    if got != want:
        extra = [r for r in got if r not in want][:3] if len(got) < 5000 else got[:2]
        lack = [r for r in want if r not in got][:3] if len(got) < 5000 else want[:2]
        return f"{len(got)} rows vs {len(want)}; only Spark {extra}; only SQL {lack}"
    return ""
