"""Spark result against DuckDB SQL over the same files: names, row count and every value."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES.split():
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _sorted_rows(rows, names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


KINDS = {
    "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = _sorted_rows(cur.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    actual = _sorted_rows(df.collect(), df.columns)
    found = [f"rows {len(actual)} != {len(expected)}"] if len(actual) != len(expected) else []
    declared = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    found += [f"type of {c}: {t} != {declared[c]}" for c, t in df.dtypes if KINDS.get(t) != declared[c]]
    for a, b in zip(actual, expected, strict=False):
        if a != b:
            found.append(f"{sorted(names)}\n  {a}\n  {b}")
            break
    return found
