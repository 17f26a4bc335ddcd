"""Compare a Spark result with the oracle's, regardless of row and column order."""

from __future__ import annotations

import math
import os
from datetime import date, datetime

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
# Column families that must agree between the engines.
FAMILIES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
            "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_dir, t)}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, datetime):
        return v.isoformat()
    if isinstance(v, date):
        return v.isoformat()
    return v


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows) if not rows or not any(
        v is None for r in rows for v in r) else sorted(
        (tuple(_value(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if both results agree in columns, types and values."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    rows = cur.fetchall()
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns: {sorted(df.columns)} vs {sorted(names)}"]
    for name, kind in df.dtypes:
        if FAMILIES.get(kind, kind) != types[name]:
            out.append(f"type of {name}: {kind} vs {types[name]}")
    mine = _sorted(df.columns, [tuple(r) for r in df.collect()])
    theirs = _sorted(names, rows)
    if len(mine) != len(theirs):
        out.append(f"rows: {len(mine)} vs {len(theirs)}")
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        out.append(f"{len(bad)} rows differ, first: {bad[0][0]} vs {bad[0][1]}")
    return out
