"""Holds a Spark result against the same question asked of DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb
from pyspark.sql import DataFrame

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(x: object) -> object:
    if isinstance(x, bool) or x is None or isinstance(x, str):
        return x
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 6)
    if isinstance(x, dt.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, (dt.date, dt.timedelta)):
        return str(x)
    if isinstance(x, dict):
        return sorted((str(k), _plain(v)) for k, v in x.items())
    if isinstance(x, (list, tuple)):
        return [_plain(v) for v in x]
    return x


def _key(row: list) -> str:
    return repr([round(v, 3) if isinstance(v, float) else v for v in row])


def rows_of(columns: list[str], rows: list[tuple]) -> list[list]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_plain(r[i]) for i in order] for r in rows), key=_key)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def differences(df: DataFrame, sql: str, sf_dir: str) -> list[str]:
    """What differs, in words; empty if nothing does."""
    found = connect(sf_dir).execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} and {sorted(names)}"]
    want, got = rows_of(names, found.fetchall()), rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(want) != len(got):
        return [f"{len(got)} rows, not {len(want)}", *map(str, got[:3]), *map(str, want[:3])]
    return [f"{g} is not {w}" for g, w in zip(got, want, strict=True) if not _same(g, w)][:5]


def _same(a: object, b: object) -> bool:
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(_same, a, b))
    if isinstance(a, (int, float)) and isinstance(b, (int, float)) and not isinstance(a, bool):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-6)
    return a == b
